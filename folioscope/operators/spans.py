"""Spans over one text axis: location of quotes, interval unions, containment and overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import text as T
from .batches import pieces
from .sweep import both_ends, disjoint, overlap_pairs


def _ascii_words(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Of a string column: the row, text, place in the row and code-point offset of each run of a-z, 0-9 (A-Z folded)."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    fold = np.zeros(256, np.uint8)
    fold[48:58], fold[97:123], fold[65:91] = np.arange(48, 58), np.arange(97, 123), np.arange(97, 123)
    data = fold[raw]
    inside = np.concatenate([[False], data != 0, [False]])
    border = np.zeros(len(raw) + 1, bool)  # a word ends with its row
    border[offsets] = True
    begin = np.flatnonzero(inside[1:] & (~inside[:-1] | border))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | border))
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    row = np.searchsorted(offsets, begin, side="right") - 1
    letters = data[data != 0].tobytes()
    text = pa.StringArray.from_buffers(len(begin), pa.py_buffer(np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32).tobytes()), pa.py_buffer(letters))
    first = np.searchsorted(row, np.arange(len(column)))
    return row, text, np.arange(len(row)) - first[row], points[begin] - points[offsets[row]]


def word_offsets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, word, at): tokens with their code-point offset. A narrow map over whole texts: no shuffle, no sort."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (piece for batch in batches for piece in pieces(batch, 1)):
            row, word, pos, at = _ascii_words(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(pos.astype(np.int32)), word, pa.array(at.astype(np.int32))], names=[key, "pos", "word", "at"])

    return docs.select(key, F.coalesce(F.col(text), F.lit("")).alias(text)).mapInArrow(run, f"{key} {dict(docs.dtypes)[key]}, pos int, word string, at int")


def timed_words(docs: DataFrame, key: str, body: str) -> DataFrame:
    """(key, pos, word, at): words of ``{{t:SEC}}word`` bodies, each at its own second."""
    marks = F.regexp_extract_all(F.col(body), F.lit("\\{\\{t:[0-9.]+\\}\\}[^{]*"), F.lit(0))
    rows = docs.select(key, F.posexplode(marks).alias("mark", "m"))
    words = rows.select(key, "mark", F.regexp_extract("m", "t:([0-9.]+)", 1).try_cast("double").alias("at"), F.posexplode(T.tokens(F.regexp_extract("m", "\\}\\}(.*)$", 1))).alias("_k", "word"))
    order = Window.partitionBy(key).orderBy("mark", "_k")
    return words.select(key, (F.row_number().over(order) - 1).alias("pos"), "word", "at")


def line_words(docs: DataFrame, key: str, body: str) -> DataFrame:
    """(key, pos, word, at): words of ``HH:MM:SS.d text`` lines, each at its line's start."""
    from ..functions.codes import parse_timecode

    lines = docs.select(key, F.posexplode(F.split(F.col(body), "\n")).alias("line", "l"))
    stamp = F.regexp_extract("l", "^([0-9]+:[0-9]{2}:[0-9]{2}(?:\\.[0-9]+)?) ", 1)
    words = lines.where(stamp != "").select(key, "line", parse_timecode(stamp).alias("at"), F.posexplode(T.tokens(F.regexp_replace("l", "^[0-9:.]+ ", ""))).alias("_k", "word"))
    order = Window.partitionBy(key).orderBy("line", "_k")
    return words.select(key, (F.row_number().over(order) - 1).alias("pos"), "word", "at")


def _bare(quote: Column) -> Column:
    return F.regexp_replace(quote, "[.,;:!?\"' ]+$", "")


def locate(text: Column, quote: Column, start: Column | None = None) -> Column:
    """0-based start of a quote at or after ``start``, retried without closing punctuation; -1 if broken."""
    at = F.lit(1) if start is None else start + 1
    found = lambda q: F.call_function("locate", q, text, at)
    bare = _bare(quote)
    return F.when(found(quote) > 0, found(quote) - 1).when((F.length(bare) > 0) & (found(bare) > 0), found(bare) - 1).otherwise(F.lit(-1))


def quote_status(text: Column, quote: Column) -> Column:
    """contiguous (the whole quote), elided (fragments in order), reordered (a fragment stands only before its predecessor) or broken (nowhere)."""
    parts = F.filter(F.transform(F.split(quote, "\\.\\.\\.|…"), lambda p: F.trim(p)), lambda p: p != "")
    begin = F.struct(F.lit(0).cast("int").alias("cursor"), F.lit("elided").alias("status"))

    def step(acc: Column, p: Column) -> Column:
        at = locate(text, p, acc["cursor"])
        lost = F.when(locate(text, p) >= 0, "reordered").otherwise("broken")
        bare = F.when(F.call_function("locate", p, text, acc["cursor"] + 1) > 0, p).otherwise(_bare(p))
        found = F.when(at >= 0, F.struct((at + F.length(bare)).cast("int").alias("cursor"), F.lit("elided").alias("status"))).otherwise(F.struct(acc["cursor"].alias("cursor"), lost.alias("status")))
        return F.when(acc["status"] == "elided", found).otherwise(acc)

    walk = F.aggregate(parts, begin, step, lambda acc: acc["status"])
    return F.when((F.trim(quote) != "") & (locate(text, quote) >= 0), "contiguous").when(F.size(parts) > 1, walk).otherwise("broken")


def _blocks(quotes: DataFrame) -> Iterator[list[tuple]]:
    """(item, quote, quote without closing punctuation) rows, in blocks of bounded text."""
    rows, n = [], 0
    for r in quotes.toLocalIterator():
        rows.append((r[0], r[1], r[2]))
        n += len(r[1])
        if n >= QUOTE_CHARS:
            yield rows
            rows, n = [], 0
    yield rows


class _Finder:
    """Where any of some quotes stands in a text: an automaton over their first characters finds the places, a comparison confirms."""

    _kept: dict[int, _Finder] = {}

    def __init__(self, rows: list[tuple]):
        import ahocorasick

        self.rows = rows
        self.heads = ahocorasick.Automaton()
        by_head: dict[str, list[tuple[int, bool, str]]] = {}
        for k, (_, quote, bare) in enumerate(rows):
            for plain, form in ((False, quote), (True, bare)):
                if form and not (plain and form == quote):
                    by_head.setdefault(form[:HEAD_CHARS], []).append((k, plain, form))
        for head, forms in by_head.items():
            self.heads.add_word(head, (len(head), forms))
        if by_head:
            self.heads.make_automaton()

    @classmethod
    def of(cls, shared) -> _Finder:
        """One for each worker process and block."""
        if id(shared.value) not in cls._kept:
            cls._kept.clear()
            cls._kept[id(shared.value)] = cls(shared.value)
        return cls._kept[id(shared.value)]

    def search(self, text: str) -> list[tuple[int, int]]:
        """(row, first place) of each quote; one found only without its closing punctuation stands there."""
        whole: dict[int, int] = {}
        bare: dict[int, int] = {}
        if len(self.heads):
            for last, (n, forms) in self.heads.iter(text):
                at = last + 1 - n
                for k, plain, form in forms:
                    found = bare if plain else whole
                    if k not in found and text.startswith(form, at):
                        found[k] = at
        return sorted((bare | whole).items())


def quote_locations(docs: DataFrame, quotes: DataFrame) -> DataFrame:
    """Where each quote stands first in any document; quotes found nowhere come once, as broken.

    Documents never meet quotes in a join: the quotes go out in blocks of ``QUOTE_CHARS`` characters, and each block is one narrow pass over
    the documents. Case and runs of white space don't count; an empty quote stands nowhere.
    """
    sc = docs.sparkSession.sparkContext
    q = quotes.select("item_id", T.collapsed(T.lowered(F.coalesce("text", F.lit("")))).alias("quote"))
    q = q.select("item_id", "quote", _bare(F.col("quote")).alias("bare"))
    d = docs.select("doc_id", T.collapsed(T.lowered(F.coalesce("text", F.lit("")))).alias("text"))
    item, doc = dict(q.dtypes)["item_id"], dict(d.dtypes)["doc_id"]

    def passing(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = _Finder.of(shared)
            for b in batches:
                rows = [(finder.rows[k][0], i, at, at + len(finder.rows[k][1])) for i, t in enumerate(b.column(1).to_pylist()) for k, at in finder.search(t)]
                items, place, start, end = zip(*rows, strict=True) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(items, kind), b.column(0).take(pa.array(place, pa.int64())), pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["item_id", "doc_id", "start", "end"])

        return run

    kind = to_arrow_type(q.schema["item_id"].dataType)
    hits = None
    for block in _blocks(q):
        one = d.mapInArrow(passing(sc.broadcast(block)), f"item_id {item}, doc_id {doc}, start long, end long")
        hits = one if hits is None else hits.unionByName(one)
    hits = hits.withColumn("status", F.lit("contiguous"))
    # one search for both uses: a quote's row without a document says that it exists
    every = q.select("item_id", F.lit(None).cast(doc).alias("doc_id"), F.lit(-1).cast("long").alias("start"), F.lit(-1).cast("long").alias("end"), F.lit("broken").alias("status"))
    found = Window.partitionBy("item_id")
    out = hits.unionByName(every.distinct()).withColumn("_n", F.count("doc_id").over(found))
    return out.where("doc_id is not null or _n = 0").drop("_n")


QUOTE_CHARS, HEAD_CHARS = 8 << 20, 32


def union_coverage(gold: DataFrame, spans: DataFrame, keys: list[str], gold_id: str) -> DataFrame:
    """Length of each gold span that the union of the key's spans covers: sums up to both its ends over spans made disjoint, without pairs."""
    most = 3 * spans.count() + 2 * gold.count()  # endpoints that either sweep meets
    found = both_ends(gold, disjoint(spans, keys, most=most), keys, [gold_id], most=most)
    kind = "long" if dict(gold.dtypes)["start"] in ("int", "bigint", "smallint", "tinyint") else "double"
    return found.select(*keys, gold_id, (F.col("end") - F.col("start")).alias("length"), F.col("length").cast(kind).alias("covered"))


def _on_axis(points: DataFrame, spans: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Points with the spans of their key round them, both ends included. Key and stretch of the axis are the join's key.

    A stretch is as long as the mean span, so spans reach over three stretches on average, whatever their lengths.
    """
    width = spans.agg(F.greatest(F.avg(F.col("end") - F.col("start")), F.lit(1.0)).alias("w")).first().w or 1.0
    stretch = lambda c: F.floor(F.col(c) / F.lit(width))
    reach = spans.where("end >= start").withColumn("_stretch", F.explode(F.sequence(stretch("start"), stretch("end"))))
    return points.withColumn("_stretch", stretch(at)).join(reach, [*keys, "_stretch"]).where(F.col(at).between(F.col("start"), F.col("end"))).drop("_stretch")


def smallest_container(points: DataFrame, spans: DataFrame, keys: list[str], point_id: str, at: str, span_id: str, first: list[str]) -> DataFrame:
    """The narrowest closed span round each point, ties to the first in ``first`` order; points outside all are kept with null."""
    inside = _on_axis(points, spans, keys, at)
    best = inside.groupBy(*keys, point_id).agg(F.min_by(span_id, F.struct((F.col("end") - F.col("start")).alias("width"), *first)).alias("bound"))
    return points.join(best, [*keys, point_id], "left")


def exact_container(points: DataFrame, spans: DataFrame, keys: list[str], point_id: str, at: str, span_id: str) -> DataFrame:
    """Half-open containment, narrowest by the *sum* of a container's spans; bound only if one container is narrowest."""
    total = spans.groupBy(*keys, span_id).agg(F.sum(F.col("end") - F.col("start")).alias("total"))
    inside = _on_axis(points, spans, keys, at).where(F.col(at) < F.col("end")).select(*keys, point_id, span_id).distinct().join(total, [*keys, span_id])
    low = inside.groupBy(*keys, point_id).agg(F.min("total").alias("total"))
    best = inside.join(low, [*keys, point_id, "total"]).groupBy(*keys, point_id).agg(F.count(F.lit(1)).alias("n"), F.min(span_id).alias("bound"))
    return points.join(best.where("n = 1").drop("n"), [*keys, point_id], "left")


def overlaps(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of half-open spans (l0, l1) and (r0, r1) of one key that share something, by a plane sweep."""
    return overlap_pairs(left, right, keys)


def neighbour_overlaps(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Spans that begin before their predecessor in (start, end) order ends."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    return spans.withColumn("previous_end", F.lag("end").over(w)).where("previous_end > start")


def multipart_iou(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Intersection over union of two multi-part spans of each key; parts of one side don't overlap."""
    both = left.select(*keys, F.col("start").alias("l0"), F.col("end").alias("l1")).join(right.select(*keys, F.col("start").alias("r0"), F.col("end").alias("r1")), keys)
    common = both.groupBy(*keys).agg(F.sum(F.greatest(F.lit(0), F.least("l1", "r1") - F.greatest("l0", "r0"))).alias("common"))
    width = lambda df, n: df.groupBy(*keys).agg(F.sum(F.col("end") - F.col("start")).alias(n))
    out = common.join(width(left, "a"), keys).join(width(right, "b"), keys)
    return out.select(*keys, F.try_divide(F.col("common").cast("double"), F.col("a") + F.col("b") - F.col("common")).alias("iou"))


def line_range_iou(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Inclusive line ranges."""
    common = F.least(a1, b1) - F.greatest(a0, b0) + 1
    return F.when(common <= 0, F.lit(0.0)).otherwise(common / (F.greatest(a1, b1) - F.least(a0, b0) + 1))


def drop_overlapping(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Greedy: in start order, spans that begin before the last kept end go. Sequential within a key, so a fold over its sorted array."""
    ordered = spans.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("xs"))
    empty = F.struct(F.lit(None).cast("long").alias("reach"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("out"))
    step = lambda acc, x: F.when(acc["reach"].isNull() | (x["start"] >= acc["reach"]), F.struct(x["end"].cast("long").alias("reach"), F.concat(acc["out"], F.array(F.struct(x["start"].cast("long").alias("start"), x["end"].cast("long").alias("end")))).alias("out"))).otherwise(acc)
    return ordered.select(*keys, F.inline(F.aggregate("xs", empty, step, lambda acc: acc["out"])))


def chapter_spans(docs: DataFrame, key: str, body: str) -> DataFrame:
    """(key, label, start, end): text after a ``<!-- chapter: L -->`` marker up to the next marker."""
    marker = "<!-- chapter: ([^>]*?) -->"
    pieces = docs.select(key, F.posexplode(F.regexp_extract_all(F.concat(F.col(body), F.lit("<!-- chapter: end -->")), F.lit("(?s).*?<!-- chapter: [^>]*? -->"), F.lit(0))).alias("_k", "piece"))
    w = Window.partitionBy(key).orderBy("_k")
    ends = pieces.select(key, "_k", F.regexp_extract("piece", marker, 1).alias("label"), F.length(F.regexp_extract("piece", marker, 0)).alias("mark"), F.sum(F.length("piece")).over(w).alias("after"))
    out = ends.withColumn("end", F.lead(F.col("after") - F.col("mark")).over(w))
    return out.where("end is not null").select(key, "label", F.col("after").alias("start"), "end")
