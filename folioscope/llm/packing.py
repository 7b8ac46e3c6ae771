"""Operator 5, best-fit packing: minimum bin slack.

Documents become pieces of at most ``CAPACITY`` tokens. Only the number of pieces of each length (at most ``CAPACITY``
counts, however large the corpus) reaches the driver. There, each bin takes the longest length left and the fullest
feasible combination of the others, found by subset sums on a bitset; the combination is removed as often as the counts allow
and becomes one line of the plan. Pieces of one length are numbered in salted groups, and the plan, bounded by the number of lengths,
turns a piece's number into a sequence and an offset.

Defined cases: a null or empty text is the end token alone; a text of any length is cut into as many pieces as it needs; an empty table gives an empty
one; repeated rows and ids, null ids included, are packed each by itself; equal lengths go in order of a hash of the piece, then of its id; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch, narrow, partitions, slices
from .subwords import WordBpe

CAPACITY, END = 4096, 1
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths whose sum is the largest of at most ``room``."""
    bits, full, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, bits))
            bits |= (bits << (length * take)) & full
            left -= take
            take *= 2
        if bits >> room & 1:
            break
    at, chosen = bits.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + take
            at -= length * take
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(times, how many of each length): combinations that use up the counts."""
    counts, lines = {k: v for k, v in counts.items() if v}, []
    while counts:
        longest = max(counts)
        rest = {k: v - (k == longest) for k, v in counts.items() if v > (k == longest)}
        chosen = fullest(rest, capacity - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(counts[k] // n for k, n in chosen.items())
        for k, n in chosen.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
        lines.append((times, chosen))
    return lines


def placement(lines: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """The plan as a table sorted by (length, first number): number range, pieces a bin, first bin, offset in the bin."""
    rows, used, bins = [], {}, 0
    for times, chosen in lines:
        offset = 0
        for length in sorted(chosen, reverse=True):
            n = chosen[length]
            rows.append((length, used.get(length, 0), n, bins, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        bins += times
    table = np.array(sorted(rows) or np.zeros((0, 5)), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "each", "bin", "offset"), table.T, strict=True))


def to_pieces(vocabulary: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe.shared(vocabulary)
        end, step = np.uint32(END).tobytes(), 4 * capacity
        for b in slices(batches):
            rows = []
            for doc_id, ids in zip(b.column(0).to_pylist(), bpe.encode(b.column(1).to_pylist()), strict=True):
                ids += end
                rows += [(doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)) for k, at in enumerate(range(0, len(ids), step)) for part in (ids[at : at + step],)]
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 1 else pa.int64()) for k, c in enumerate(cols)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def best_fit_packing(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: its tokens' place in its document and in a sequence."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    salts = max(8, partitions(spark))
    # a piece's salt depends on its row alone, so a lost task's numbering comes back the same
    pieces = scratch.save(narrow(docs, "doc_id", "text").mapInArrow(to_pieces(vocabulary, capacity), _PIECES), "pieces")
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    groups = pieces.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    groups = scratch.save(groups, "groups")
    counts = {r.length: r.n for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(placement(plan(counts, capacity)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "start")
    numbered = pieces.withColumn("nth", F.row_number().over(within) - 1).join(groups, ["length", "salt"])
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("nth"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        key = t["length"] << 40 | t["first"]
        for b in batches:
            length, nth = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = np.searchsorted(key, length << 40 | nth, side="right") - 1
            index = nth - t["first"][at]
            sequence = t["bin"][at] + index // t["each"][at]
            offset = t["offset"][at] + index % t["each"][at] * length
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered.mapInArrow(place, _PIECES + ", sequence_id long, offset long")
