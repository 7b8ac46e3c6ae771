"""Alignment of two word streams of each key: anchors first, then the longest common subsequence of what lies between them.

1. runs of ``GRAM`` words that stand once in each stream are joined; neighbouring ones on one diagonal make up segments;
2. the heaviest chain of segments that rises in both streams is kept: for each key as many rows as there are segments, not words;
3. the stretches between them, as word arrays, get an exact longest common subsequence in linear memory: the table's rows are bit vectors, and the
   stream is halved where the forward and the backward row add up to most.

Words of a stream that is much repeated have no anchors, so all of it is one stretch, aligned exactly.

Streams that stand in one row as arrays are aligned by a narrow map, many rows in a batch; streams of words in rows of their own are put together first, so each
word is shuffled once. Streams of more than ``LONG`` words are aligned by joins, and only words of one stretch come together.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import saved

#: Words of an anchor; words of a stream beyond which it is no array; words that a map takes at once.
GRAM, LONG, WORDS = 8, 1_000_000, 500_000
_PLACES = "array<struct<l:int,r:int>>"


def _prefix_lengths(a: list, b: list) -> np.ndarray:
    """For each prefix of b the length of its longest common subsequence with a: a row of the table as the zero bits of one number."""
    where: dict = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        if hit:
            row = (row + hit | row - hit) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes((len(b) + 7) // 8, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def common_subsequence(a: list, b: list) -> list[tuple[int, int]]:
    """The places (in a, in b) of a longest common subsequence, by halving; memory grows with the longer stream alone."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, m = todo.pop()
        while i < k and j < m and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < k and j < m and a[k - 1] == b[m - 1]:
            k, m = k - 1, m - 1
            out.append((k, m))
        if i >= k or j >= m:
            continue
        if k - i == 1:
            at = next((x for x in range(j, m) if b[x] == a[i]), None)
            if at is not None:
                out.append((i, at))
            continue
        half = (i + k) // 2
        ahead = _prefix_lengths(a[i:half], b[j:m])
        back = _prefix_lengths(a[half:k][::-1], b[j:m][::-1])[::-1]
        cut = j + int((ahead + back).argmax())
        todo += [(i, half, j, cut), (half, k, cut, m)]
    return sorted(out)


def chain(l: np.ndarray, r: np.ndarray, n: np.ndarray) -> list[int]:  # noqa: E741
    """Segments (l, r, n) of the heaviest chain that rises strictly in both streams, by the places where their runs begin.

    In order of l; a segment counts for later ones once its own places lie behind. A tree of maxima over r answers which chain is heaviest so far.
    """
    order = np.lexsort((r, l))
    ends = np.unique(r + n)
    best: list[tuple[int, int]] = [(0, -1)] * (len(ends) + 1)  # (weight, segment) by end in r
    weight, before = np.zeros(len(l), np.int64), np.full(len(l), -1)
    waiting: list[tuple[int, int]] = []
    for i in order.tolist():
        while waiting and waiting[0][0] <= l[i]:
            _, j = heapq.heappop(waiting)
            at = int(np.searchsorted(ends, r[j] + n[j])) + 1
            while at <= len(ends):
                best[at] = max(best[at], (int(weight[j]), j))
                at += at & -at
        top, at = (0, -1), int(np.searchsorted(ends, r[i], "right"))
        while at:
            top = max(top, best[at])
            at -= at & -at
        weight[i], before[i] = top[0] + n[i], top[1]
        heapq.heappush(waiting, (int(l[i] + n[i]), i))
    out = []
    i = int(weight.argmax()) if len(l) else -1
    while i >= 0:
        out.append(i)
        i = int(before[i])
    return out[::-1]


def _anchors(left: DataFrame, right: DataFrame, key: str, gram: int) -> DataFrame:
    """(key, l, r, n): runs of grams that stand once in both streams, on one diagonal."""
    w = Window.partitionBy(key).orderBy("pos")

    def once(df: DataFrame, at: str) -> DataFrame:
        grams = df.select(key, "pos", F.concat_ws(" ", "word", *[F.lead("word", k).over(w) for k in range(1, gram)]).alias("gram"), F.lead("pos", gram - 1).over(w).alias("_last"))
        return grams.where("_last is not null").groupBy(key, "gram").agg(F.count(F.lit(1)).alias("_n"), F.min("pos").alias(at)).where("_n = 1").select(key, "gram", at)

    both = once(left, "l").join(once(right, "r"), [key, "gram"]).select(key, "l", "r")
    run = Window.partitionBy(key, "_diagonal").orderBy("l")
    islands = both.withColumn("_diagonal", F.col("l") - F.col("r")).withColumn("_island", F.col("l") - F.row_number().over(run))
    return islands.groupBy(key, "_diagonal", "_island").agg(F.min("l").alias("l"), F.min("r").alias("r"), F.count(F.lit(1)).alias("n")).select(key, "l", "r", "n")


def _cut(segments: list[tuple[int, int, int]], gram: int, n_left: int, n_right: int) -> list[tuple[bool, int, int, int, int]]:
    """(matched, l0, l1, r0, r1): the runs of words that a chain's segments (l, r, n) match, and the stretches between them."""
    rows, at_l, at_r = [], 0, 0
    for l, r, n in segments:  # noqa: E741
        # a segment covers gram - 1 words beyond its last beginning; what the one before has covered is cut off
        size = n + gram - 1
        cut = max(0, at_l - l, at_r - r)
        if cut >= size:
            continue
        rows.append((False, at_l, l + cut, at_r, r + cut))
        rows.append((True, l + cut, l + size, r + cut, r + size))
        at_l, at_r = l + size, r + size
    rows.append((False, at_l, n_left, at_r, n_right))
    return [x for x in rows if x[2] > x[1] and x[4] > x[3]]


def _chained(key: str, gram: int):
    """Of each key, a row with its segments, the runs of words that the chain matches, and the stretches between them."""

    def stretches(segments: list, n_left: int, n_right: int) -> list[tuple[bool, int, int, int, int]]:
        l, r, n = (np.array([x[c] for x in segments], np.int64) for c in ("l", "r", "n"))  # noqa: E741
        return _cut([(int(l[i]), int(r[i]), int(n[i])) for i in chain(l, r, n)], gram, n_left, n_right)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            found = [stretches([] if x is None else list(x), int(a), int(b)) for x, a, b in zip(df["segments"], df["n_left"], df["n_right"], strict=True)]
            which = np.repeat(np.arange(len(df)), [len(f) for f in found])
            out = pd.DataFrame([x for f in found for x in f], columns=["matched", "l0", "l1", "r0", "r1"])
            out.insert(0, key, df[key].take(which).reset_index(drop=True))
            yield out

    return run


def _shared_once(left: np.ndarray, left_at: np.ndarray, right: np.ndarray, right_at: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The places, in order of the left one, of runs of ``gram`` codes that stand once in both streams of a row; row i has the codes ``at[i] : at[i + 1]``."""

    def begins(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = np.maximum(np.diff(at) - gram + 1, 0)
        row = np.repeat(np.arange(len(n)), n)
        return row, np.arange(len(row)) - (np.cumsum(n) - n)[row] + at[row]

    (l_row, l_begin), (r_row, r_begin) = begins(left_at), begins(right_at)
    row, begin = np.concatenate([l_row, r_row]), np.concatenate([l_begin, r_begin + len(left)])
    codes = np.concatenate([left, right]).astype(np.uint64)
    seed = 0x9E3779B97F4A7C15
    while True:
        hashed = row.astype(np.uint64)
        for k in range(gram):
            hashed = (hashed ^ hashed >> np.uint64(29)) * np.uint64(seed) + codes[begin + k]
        order = np.argsort(hashed, kind="stable")
        ordered = hashed[order]
        same = ordered[1:] == ordered[:-1]
        x, y = order[1:][same], order[:-1][same]
        if (row[x] == row[y]).all() and all((codes[begin[x] + k] == codes[begin[y] + k]).all() for k in range(gram)):
            break
        seed = (seed * 6364136223846793005 + 1442695040888963407 | 1) & (1 << 64) - 1  # two runs with one hash: another one
    # a group of two, of which the first, by the stable order, stands left and the second right
    apart = np.concatenate([[True], ~same, [True]])
    first = np.flatnonzero(apart[:-2] & ~apart[1:-1] & apart[2:])
    l, r = order[first], order[first + 1]  # noqa: E741
    across = (l < len(l_begin)) & (r >= len(l_begin))
    l, r = begin[l[across]], begin[r[across]] - len(left)  # noqa: E741
    by = np.argsort(l)
    return l[by], r[by]


def _common_words(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """As ``common_subsequence``; words that stand in one stretch alone are left out first."""
    in_b = set(b)
    mine = [i for i, x in enumerate(a) if x in in_b]
    if not mine:
        return []
    in_a = {a[i] for i in mine}
    other = [j for j, y in enumerate(b) if y in in_a]
    return [(mine[i], other[j]) for i, j in common_subsequence([a[i] for i in mine], [b[j] for j in other])]


def align_codes(left: np.ndarray, left_at: np.ndarray, right: np.ndarray, right_at: np.ndarray, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of places of each row, l, r) of rows of two streams of codes, ``at[i] : at[i + 1]`` those of row i; places count from 0 in each row, in order."""
    l, r = _shared_once(left, left_at, right, right_at, gram)  # noqa: E741
    row = np.searchsorted(left_at, l, "right") - 1
    l, r = l - left_at[row], r - right_at[row]  # noqa: E741
    new = np.ones(len(l), bool)
    new[1:] = (row[1:] != row[:-1]) | (l[1:] != l[:-1] + 1) | (r[1:] != r[:-1] + 1)
    at = np.flatnonzero(new)
    n, row, l, r = np.diff(np.append(at, len(l))), row[at], l[at], r[at]  # noqa: E741
    # where all segments rise, all of them are the heaviest chain
    turns = np.unique(row[1:][(row[1:] == row[:-1]) & (r[1:] < r[:-1] + n[:-1])])
    crossed = np.zeros(len(left_at) - 1, bool)
    crossed[turns] = True
    first = np.searchsorted(row, np.arange(len(left_at)))
    runs: list[tuple[int, int, int]] = []
    sizes = np.zeros(len(left_at) - 1, np.int64)
    for i in range(len(left_at) - 1):
        a, b = left[left_at[i] : left_at[i + 1]].tolist(), right[right_at[i] : right_at[i + 1]].tolist()
        if not a or not b:
            continue
        s = slice(first[i], first[i + 1])
        kept = list(zip(l[s].tolist(), r[s].tolist(), n[s].tolist(), strict=True))
        if crossed[i]:
            kept = [kept[j] for j in chain(l[s], r[s], n[s])]
        begun = len(runs)
        for matched, l0, l1, r0, r1 in _cut(kept, gram, len(a), len(b)):
            if matched:
                runs.append((l0, r0, l1 - l0))
            else:
                runs += [(l0 + x, r0 + y, 1) for x, y in _common_words(a[l0:l1], b[r0:r1])]
        sizes[i] = sum(x[2] for x in runs[begun:])
    l0, r0, n = np.array(runs, np.int64).reshape(-1, 3).T
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return sizes, np.repeat(l0, n) + step, np.repeat(r0, n) + step


def _lists(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, at, places): the words of a column of arrays without nulls, where each row's begin, and their places in the row."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
    words = column.flatten()
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(words)) - (np.cumsum(lengths) - lengths)[row]
    if words.null_count:
        known = np.asarray(pc.is_valid(words))
        words, row, place = words.drop_null(), row[known], place[known]
    return words, np.searchsorted(row, np.arange(len(lengths) + 1)), place


def aligned(rows: DataFrame, left: str, right: str, gram: int = GRAM) -> DataFrame:
    """``rows`` with ``places``, array of (l, r), for two arrays of words: the places of words that stand in both, rising in both. A narrow map over whole rows; nulls match nothing."""
    others = [c for c in rows.columns if c not in (left, right)]
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    kind = pa.list_(pa.struct([("l", pa.int32()), ("r", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (piece for batch in batches for piece in _pieces(batch)):
            (lw, left_at, l_place), (rw, right_at, r_place) = _lists(b.column(0)), _lists(b.column(1))
            codes = np.asarray(pa.concat_arrays([lw, rw]).dictionary_encode().indices)
            sizes, l, r = align_codes(codes[: len(lw)], left_at, codes[len(lw) :], right_at, gram)  # noqa: E741
            row = np.repeat(np.arange(b.num_rows), sizes)
            pair = pa.StructArray.from_arrays([pa.array(l_place[left_at[row] + l].astype(np.int32)), pa.array(r_place[right_at[row] + r].astype(np.int32))], fields=list(kind.value_type))
            places = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pair)
            yield pa.RecordBatch.from_arrays([*b.columns[2:], places.cast(kind)], names=[*others, "places"])

    shape = ", ".join(f"`{c}` {fields[c]}" for c in others) + f"{', ' if others else ''}places {_PLACES}"
    return rows.select(left, right, *(F.col(f"`{c}`") for c in others)).mapInArrow(run, shape)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch's rows in order, in slices of at most ``WORDS`` words of both arrays, or of one longer row."""
    upto = np.cumsum(sum(np.asarray(pc.fill_null(pc.list_value_length(batch.column(k)), 0), np.int64) for k in (0, 1)))
    first = 0
    while first < batch.num_rows:
        before = int(upto[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(upto, before + WORDS, "right")))
        yield batch.slice(first, last - first)
        first = last


def matched_words(left: DataFrame, right: DataFrame, key: str, gram: int = GRAM, long: int = LONG) -> DataFrame:
    """(key, l, r): the places of words that stand in both streams, rising in both; each stream has (key, pos, word), pos counting from 0.

    Keys of one stream alone have no rows; rows with a null are left out, and places are counted anew without them. The place of a word stays its ``pos``.
    """
    left, right = (df.select(key, "pos", "word").dropna() for df in (left, right))
    beyond = lambda df: df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > long).select(key)
    many = saved(beyond(left).unionByName(beyond(right)).distinct())
    if many.isEmpty():
        return _by_arrays(left, right, key, gram)
    parts = [df.hint("merge").join(many, key, how) for how in ("left_anti", "left_semi") for df in (left, right)]
    return _by_arrays(parts[0], parts[1], key, gram).unionByName(_by_joins(parts[2], parts[3], key, gram))


def _by_arrays(left: DataFrame, right: DataFrame, key: str, gram: int) -> DataFrame:
    """Both streams of a key as arrays of one row, in one shuffle."""
    kinds = dict(left.dtypes)["pos"], dict(right.dtypes)["pos"]
    side = lambda df, tag: df.select(key, F.lit(tag).alias("_side"), F.struct(F.col("pos").cast("long").alias("pos"), F.col("word").alias("word")).alias("_x"))
    stream = lambda tag: F.array_sort(F.collect_list(F.when(F.col("_side") == tag, F.col("_x"))))
    both = side(left, "l").unionByName(side(right, "r")).groupBy(key).agg(stream("l").alias("_l"), stream("r").alias("_r")).where("size(_l) > 0 and size(_r) > 0")
    at = aligned(both.select(key, F.col("_l.word").alias("lw"), F.col("_r.word").alias("rw"), F.col("_l.pos").alias("lp"), F.col("_r.pos").alias("rp")), "lw", "rw", gram)
    places = F.transform("places", lambda x: F.struct(F.get("lp", x["l"]).cast(kinds[0]).alias("l"), F.get("rp", x["r"]).cast(kinds[1]).alias("r")))
    return at.select(key, F.explode(places).alias("x")).select(key, "x.l", "x.r")


def _by_joins(left: DataFrame, right: DataFrame, key: str, gram: int) -> DataFrame:
    """Only words of one stretch come together."""
    w = Window.partitionBy(key).orderBy("pos")
    clean = lambda df: df.select(key, "pos", "word").dropna().select(key, F.col("pos").alias("_given"), (F.row_number().over(w) - 1).cast("long").alias("pos"), "word")
    left, right = saved(clean(left)), saved(clean(right))  # each is read for grams, sizes, stretches and places
    size = lambda df, name: df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    sizes = size(left, "n_left").join(size(right, "n_right"), key)
    kind = dict(left.dtypes)[key]
    segments = _anchors(left, right, key, gram).groupBy(key).agg(F.collect_list(F.struct("l", "r", "n")).alias("segments"))
    parts = sizes.join(segments, key, "left").mapInPandas(_chained(key, gram), f"{key} {kind}, matched boolean, l0 long, l1 long, r0 long, r1 long")
    parts = saved(parts)
    # a stretch is one small row and stands for many words, so its table's size says nothing of theirs: no join of words may be a broadcast
    runs = parts.where("matched").select(key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("l1") - F.col("l0") - 1)).alias("_step"), "l0", "r0").select(key, (F.col("l0") + F.col("_step")).alias("l"), (F.col("r0") + F.col("_step")).alias("r"))
    gaps = parts.where("not matched")

    def words_of(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
        places = gaps.select(key, "l0", "r0", F.explode(F.sequence(F.col(a), F.col(b) - 1)).alias("pos"))
        found = places.hint("merge").join(df.select(key, "pos", "word"), [key, "pos"])
        return found.groupBy(key, "l0", "r0").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]).alias(name))

    both = words_of(left, "l0", "l1", "lw").hint("merge").join(words_of(right, "r0", "r1", "rw"), [key, "l0", "r0"])

    def between(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            found = [np.array(common_subsequence(list(lw), list(rw)), np.int64).reshape(-1, 2) + (l0, r0) for l0, r0, lw, rw in zip(df["l0"], df["r0"], df["lw"], df["rw"], strict=True)]
            which = np.repeat(np.arange(len(df)), [len(f) for f in found])
            pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
            yield pd.DataFrame({key: df[key].take(which).reset_index(drop=True), "l": pairs[:, 0], "r": pairs[:, 1]})

    places = runs.unionByName(both.mapInPandas(between, f"{key} {kind}, l long, r long"))
    given = lambda df, name: df.select(key, F.col("pos").alias(name), F.col("_given").alias(f"_{name}"))
    return places.hint("merge").join(given(left, "l"), [key, "l"]).hint("merge").join(given(right, "r"), [key, "r"]).select(key, F.col("_l").alias("l"), F.col("_r").alias("r"))
