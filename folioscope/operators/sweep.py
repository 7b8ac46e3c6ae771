"""Plane sweeps over spans: sums up to a point, and overlapping pairs, without joining all spans of a key with one another.

The axis of a key with very many rows is cut into cells at quantiles of its endpoints, so that no task gets a hot key whole. Sums up to a point are a running
window within a cell plus what the cells before it hold: one row for each cell. Pairs are swept cell by cell: a span lies in every cell
it crosses, so what is active at a border is carried across it, and a pair is counted in the cell where its later start lies.

Spans are half-open, (start, end); those with a null or with end <= start hold nothing, and rows with a null key meet nothing. Sums of whole positions are longs: enough for
a key of 10^9 spans at places up to 10^9; beyond that the sum is an error, never a wrong number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key with more endpoints is cut into ``CELLS`` cells; never more than ``MOST_HOT`` keys are, so their borders are few.
CELL_ROWS, CELLS, MOST_HOT = 2_000_000, 256, 4096
#: Rows that a task sweeps at once.
SWEPT = 200_000
#: Points and endpoints that a task of running sums sorts, on average; more of them make more tasks, not larger ones.
SUMMED = 500_000


def _known(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys) if keys else df


def with_cells(endpoints: DataFrame, keys: list[str], at: str, cell_rows: int | None = None, cells: int | None = None, most: int | None = None):
    """(borders, cell): a table (keys, _borders) of hot keys, or None, and a function from a joined row's position to its cell.

    ``most`` is a number that the endpoints don't exceed, where the caller knows one.
    """
    limit = CELL_ROWS if cell_rows is None else cell_rows
    if (endpoints.count() if most is None else most) <= limit:
        return None, lambda c: F.lit(0)
    sizes = endpoints.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n").alias("n"), F.max("_n").alias("top")).first()
    limit = max(limit, (total.n or 0) // MOST_HOT)
    if (total.top or 0) <= limit:
        return None, lambda c: F.lit(0)
    hot = sizes.where(F.col("_n") > limit).select(*keys, F.lit(True).alias("_hot"))
    n = CELLS if cells is None else cells
    mine = endpoints.join(F.broadcast(hot), keys, "left_semi") if keys else endpoints  # at most MOST_HOT rows
    cuts = F.array_distinct(F.percentile_approx(F.col(at).cast("double"), F.array(*[F.lit(k / n) for k in range(1, n)]), F.lit(100 * n)))
    borders = mine.groupBy(*keys).agg(cuts.alias("_borders"))
    return borders, lambda c: F.coalesce(F.size(F.filter("_borders", lambda b: b <= c)), F.lit(0))


def _cut(df: DataFrame, keys: list[str], borders: DataFrame | None) -> DataFrame:
    if borders is None:
        return df
    return df.join(F.broadcast(borders), keys, "left") if keys else df.crossJoin(F.broadcast(borders))  # at most MOST_HOT rows of CELLS numbers


def _number(*columns: tuple[DataFrame, str]) -> str:
    """The type in which positions are added up: longs if all are whole numbers, else decimals of six places."""
    whole = all(dict(df.dtypes)[c] in ("tinyint", "smallint", "int", "bigint") for df, c in columns)
    return "long" if whole else "decimal(38,6)"


def _marks(spans: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """Endpoints as (keys, _at, _order, _starts, _s, _ends, _e, _reach), equal ones added up."""
    good = _known(spans, keys).where("end > start").select(*keys, F.col("start").cast(kind).alias("_a"), F.col("end").cast(kind).alias("_b"))
    zero, none = F.lit(0).cast(kind), F.lit(None).cast(kind)
    row = lambda at, starts, s, ends, e, reach: F.struct(at.alias("_at"), F.lit(starts).alias("_starts"), s.alias("_s"), F.lit(ends).alias("_ends"), e.alias("_e"), reach.alias("_reach"))
    a, b = F.col("_a"), F.col("_b")
    every = good.select(*keys, F.inline(F.array(row(a, 1, a, 0, zero, b), row(b, 0, zero, 1, b, none))))
    added = [F.sum(c).alias(c) for c in ("_starts", "_s", "_ends", "_e")]
    return every.groupBy(*keys, "_at").agg(*added, F.max("_reach").alias("_reach")).withColumn("_order", F.lit(1))


def sums_upto(points: DataFrame, spans: DataFrame, keys: list[str], at: str, after: str | Column | None = None, cell_rows: int | None = None, cells: int | None = None, most: int | None = None) -> DataFrame:
    """The points with ``starts`` and ``ends``, the spans' endpoints before them, ``covered``, the spans' summed length before them, and ``reach``, the farthest end of those begun.

    Endpoints at a point itself count where ``after`` is true. A point with a null key or position has no endpoints before it.
    """
    names = points.columns
    kind = _number((points, at), (spans, "start"), (spans, "end"))
    asked = points.withColumn("_at", F.col(at).cast(kind)).withColumn("_order", F.when(F.lit(False) if after is None else F.col(after) if isinstance(after, str) else after, 2).otherwise(0))
    marks = _marks(spans, keys, kind)
    endpoints = marks.select(*keys, "_at").unionByName(asked.select(*keys, "_at"))
    most = endpoints.count() if most is None else most
    borders, cell = with_cells(endpoints, keys, "_at", cell_rows, cells, most)
    every = asked.withColumn("_asked", F.lit(True)).unionByName(marks.withColumn("_asked", F.lit(False)), allowMissingColumns=True)
    every = _cut(every, keys, borders).withColumn("_cell", cell(F.col("_at")))
    # without hot keys the rows stay clustered by the keys alone, for whatever groups by them next
    by = [*keys, *(["_cell"] if borders is not None or not keys else [])]
    if most > SUMMED and (keys or borders is not None):
        every = every.repartition(max(-(-most // SUMMED), every.sparkSession.sparkContext.defaultParallelism), *by)
    here = Window.partitionBy(*by).orderBy("_at", "_order").rowsBetween(Window.unboundedPreceding, 0)
    run = every.select("*", *[F.coalesce(F.sum(c).over(here), F.lit(0)).alias(f"{c}_upto") for c in ("_starts", "_s", "_ends", "_e")], F.max("_reach").over(here).alias("_reach_upto")).where("_asked")
    if borders is not None:
        marks = _cut(marks, keys, borders).where("_borders is not null").withColumn("_cell", cell(F.col("_at")))
        whole = marks.groupBy(*keys, "_cell").agg(*[F.sum(c).alias(c) for c in ("_starts", "_s", "_ends", "_e")], F.max("_reach").alias("_reach"))
        # cells without endpoints carry what came before, too: the sums stand at the next cell that asks
        asking = run.where("_borders is not null").select(*keys, "_cell").distinct().unionByName(whole.select(*keys, "_cell")).distinct()
        before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        carried = asking.join(whole, [*keys, "_cell"], "left").select(*keys, "_cell", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("_starts", "_s", "_ends", "_e")], F.max("_reach").over(before).alias("_reach_before"))
        run = run.join(carried, [*keys, "_cell"], "left")
        upto = lambda c: F.col(f"{c}_upto") + F.coalesce(f"{c}_before", F.lit(0))
        reach = F.greatest("_reach_upto", "_reach_before")
    else:
        upto, reach = (lambda c: F.col(f"{c}_upto")), F.col("_reach_upto")
    covered = (upto("_starts") * F.col("_at") - upto("_s")) - (upto("_ends") * F.col("_at") - upto("_e"))
    return run.select(*names, upto("_starts").cast("long").alias("starts"), upto("_ends").cast("long").alias("ends"), covered.cast("double").alias("covered"), reach.cast("double").alias("reach"))


def both_ends(ranges: DataFrame, spans: DataFrame, keys: list[str], ids: list[str], cell_rows: int | None = None, cells: int | None = None, most: int | None = None) -> DataFrame:
    """(keys, ids, start, end, length, touched): the spans' summed length within each distinct range (start, end), and how many of them share something with it.

    Up to a range's end count the spans begun before it; up to its start, those that have ended there. An empty range touches nothing.
    """
    whole = [*keys, *ids, "start", "end"]
    ends = ranges.select(*whole).select("*", F.explode(F.array(F.struct(F.col("start").alias("x"), F.lit(True).alias("first")), F.struct(F.col("end").alias("x"), F.lit(False).alias("first")))).alias("_p"))
    found = sums_upto(ends.select(*whole, F.col("_p.x").alias("_x"), F.col("_p.first").alias("_first")), spans, keys, "_x", "_first", cell_rows, cells, most)
    at = lambda c, first: F.max(F.when(F.col("_first") == first, F.col(c)))
    out = found.groupBy(*whole).agg((at("covered", False) - at("covered", True)).alias("length"), (at("starts", False) - at("ends", True)).alias("touched"))
    empty = ~F.coalesce(F.col("end") > F.col("start"), F.lit(False))
    return out.withColumn("length", F.when(empty, 0.0).otherwise(F.col("length"))).withColumn("touched", F.when(empty, 0).otherwise(F.col("touched")))


def disjoint(spans: DataFrame, keys: list[str], cell_rows: int | None = None, cells: int | None = None, most: int | None = None) -> DataFrame:
    """(keys, start, end): the union of each key's spans as spans that don't overlap: of each, what lies beyond all that begin before it."""
    good = _known(spans, keys).where("end > start").groupBy(*keys, "start").agg(F.max("end").alias("end"))
    kind = dict(spans.dtypes)["start"]
    out = sums_upto(good, good, keys, "start", None, cell_rows, cells, most).select(*keys, F.greatest("start", F.col("reach").cast(kind)).alias("start"), "end")
    return out.where("end > start")


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    many = np.maximum(last - first, 0)
    return np.repeat(first - np.cumsum(many) + many, many) + np.arange(int(many.sum()))


def _swept(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs of whole cells' left and right rows that share something and whose later start lies in the cell."""
    group = rows.column("g").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    start, end, cell, own, left = (rows.column(c).to_numpy() for c in ("s", "e", "cell", "c0", "left"))
    payload = [rows.column(c).combine_chunks() for c in ("l", "r")]
    for one in (True, False):
        # each row of one side with the rows of the other that begin within it; at equal starts the left side counts as first
        a, b = np.flatnonzero(left == one), np.flatnonzero(left != one)
        b = b[np.lexsort((start[b], group[b]))]
        if not len(a) or not len(b):
            continue
        lo, hi = (_search(group[b], start[b], group[a], x, side) for x, side in ((start[a], "left" if one else "right"), (end[a], "left")))
        for at in range(0, len(a), 4096):
            p, q = lo[at : at + 4096], hi[at : at + 4096]
            i, j = np.repeat(a[at : at + 4096], np.maximum(q - p, 0)), b[_ranges(p, q)]
            # the later start is j's
            keep = own[j] == cell[j]
            i, j = pa.array(i[keep]), pa.array(j[keep])
            yield pa.RecordBatch.from_arrays([payload[0].take(i if one else j), payload[1].take(j if one else i)], names=["l", "r"])


def _search(groups: np.ndarray, starts: np.ndarray, group: np.ndarray, x: np.ndarray, side: str) -> np.ndarray:
    """searchsorted of (group, x) in rows sorted by group and start: one search over ranks, with each group's ranks shifted beyond the one before."""
    values, place = np.unique(np.concatenate([starts, x]), return_inverse=True)
    wide = len(values)
    return np.searchsorted(groups * wide + place[: len(starts)], group * wide + place[len(starts) :], side)


def overlap_pairs(left: DataFrame, right: DataFrame, keys: list[str], cell_rows: int | None = None, cells: int | None = None) -> DataFrame:
    """Pairs of half-open spans (l0, l1) and (r0, r1) of one key that share something, with all columns of both."""
    l_names, r_names = left.columns, [c for c in right.columns if c not in keys]
    side = lambda df, a, b, is_left: _known(df, keys).where(f"{b} > {a}").select(*keys, F.col(a).cast("double").alias("s"), F.col(b).cast("double").alias("e"), F.lit(is_left).alias("left"), F.struct(*df.columns).alias("l" if is_left else "r"))
    every = side(left, "l0", "l1", True).unionByName(side(right, "r0", "r1", False), allowMissingColumns=True)
    borders, cell = with_cells(every.select(*keys, "s"), keys, "s", cell_rows, cells)
    cut = _cut(every, keys, borders).withColumn("c0", cell(F.col("s")))
    # the last cell is that of the largest position before the end, or of the end itself, which costs one empty visit at most
    cut = cut.withColumn("cell", F.explode(F.sequence(F.col("c0"), cell(F.col("e"))))) if borders is not None else cut.withColumn("cell", F.col("c0"))
    ready = cut.select(F.to_json(F.struct(*keys, "cell")).alias("g"), "s", "e", "cell", "c0", "left", "l", "r").repartition("g").sortWithinPartitions("g")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            if not b.num_rows:
                continue
            if n >= SWEPT:
                # all cells but the last one seen are complete
                table = pa.Table.from_batches(held)
                last = table.column("g")[-1]
                cut_at = pc.index(table.column("g"), last).as_py()
                if cut_at:
                    yield from _swept(table.slice(0, cut_at))
                held = table.slice(cut_at).to_batches()
                n = table.num_rows - cut_at
            held.append(b)
            n += b.num_rows
        if held:
            yield from _swept(pa.Table.from_batches(held))

    shape = f"l {ready.schema['l'].dataType.simpleString()}, r {ready.schema['r'].dataType.simpleString()}"
    return ready.mapInArrow(run, shape).select(*[F.col(f"l.{c}").alias(c) for c in l_names], *[F.col(f"r.{c}").alias(c) for c in r_names])
