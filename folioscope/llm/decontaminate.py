"""Operator 7, benchmark decontamination: Wu-Manber search for benchmark windows in documents.

The alphabet is words, not bytes. For the patterns of one length m (in words) a shift table, indexed by the hash
of a block of words, tells how far a window may move; where it may not move, the bucket of that suffix block names the
test strings, and their bytes are compared. All documents of a batch move their windows together, as lanes of
numpy arrays, so a step of the search costs no Python call a document.

The benchmark is compiled, broadcast and searched a block of about ``BLOCK_BYTES`` of text at a time. A larger benchmark makes as many passes over the
documents, with what was hit so far written to the shared folder in between, so no broadcast grows with it and one block is in memory at once.

Defined cases: null or wordless documents have no hits; a document of any length is searched whole; null or wordless items give no window; items
of fewer than ``WINDOW`` words are one window; an item id given twice counts once, and a null one never, though its windows hit; no hits give the SHA-256 of the empty string; an empty table or
benchmark gives no row or no hit; there are no ties; repeated rows and ids, null ids included, are judged each by itself; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import ROWS_PER_BATCH, Scratch, narrow, slices
from .wordhash import ALNUM, Words, windows, words

WINDOW, BLOCK_BYTES, LANE, TABLE_BITS = 10, 8 << 20, 256, 18
SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class Patterns:
    """Shift table and suffix buckets for test strings of m words."""

    def __init__(self, m: int, strings: dict[tuple[bytes, ...], set[str]]):
        self.m = m
        self.block = min(m, 3)
        self.strings = strings
        flat = [w for s in strings for w in s]
        w = words(pa.array([" ".join(x.decode("utf-8", "replace") for x in flat)]), ALNUM)
        if len(w.hashes) != len(flat):
            raise AssertionError("a pattern's words must survive their own tokenisation")
        blocks = windows(w.hashes, self.block)
        mask = (1 << TABLE_BITS) - 1
        self.shift = np.full(mask + 1, m - self.block + 1, dtype=np.int64)
        starts = np.arange(len(strings)) * m
        for j in range(m - self.block + 1):
            np.minimum.at(self.shift, (blocks[starts + j] & np.uint64(mask)).astype(np.int64), m - self.block - j)
        self.bucket: dict[int, list[tuple[bytes, ...]]] = defaultdict(list)
        for s, h in zip(strings, blocks[starts + m - self.block].tolist(), strict=True):
            self.bucket[h].append(s)

    def search(self, w: Words) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(index of the first word, test string) of each occurrence."""
        m, blocks = self.m, windows(w.hashes, self.block)
        low = w.first[:-1] + m - 1
        high = w.first[1:]
        lanes = np.maximum(0, -(-(high - low) // LANE))
        doc = np.repeat(np.arange(len(lanes)), lanes)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = low[doc] + nth * LANE
        stop = np.minimum(at + LANE, high[doc])
        found = []
        mask = np.uint64((1 << TABLE_BITS) - 1)
        while len(at):
            step = self.shift[(blocks[at - self.block + 1] & mask).astype(np.int64)]
            zero = step == 0
            if zero.any():
                found.append(at[zero])
                step = step + zero
            at = at + step
            live = at < stop
            at, stop = at[live], stop[live]
        for p in np.concatenate(found).tolist() if found else ():
            tests = self.bucket.get(int(blocks[p - self.block + 1]))
            if tests:
                here = tuple(w.data[b:e].tobytes() for b, e in zip(w.begin[p - m + 1 : p + 1], w.end[p - m + 1 : p + 1], strict=True))
                for s in tests:
                    if s == here:
                        yield p - m + 1, s


def item_words(text: str) -> tuple[bytes, ...]:
    return tuple(x for x in text.encode("utf-8").translate(bytes(ALNUM)).split(b"\x00") if x)


def compile_patterns(items: list[tuple[str, str]]) -> list[Patterns]:
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
    for item_id, text in items:
        ws = item_words(text or "")
        if ws:
            m = min(WINDOW, len(ws))
            for i in range(len(ws) - m + 1):
                by_length[m][ws[i : i + m]].update([] if item_id is None else [str(item_id)])
    return [Patterns(m, dict(s)) for m, s in sorted(by_length.items())]


def blocks_of(benchmark: DataFrame) -> Iterator[list[tuple[str, str]]]:
    """The benchmark's rows, in blocks of bounded size."""
    rows, n = [], 0
    for r in benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).toLocalIterator():
        rows.append((r.item_id, r.text))
        n += len(r.text or "")
        if n >= BLOCK_BYTES:
            yield rows
            rows, n = [], 0
    yield rows


def numbered(blocks: Iterator) -> Iterator[tuple[int, list, bool]]:
    """(number, block, whether it is the last)."""
    before = next(blocks)
    for k, block in enumerate(blocks):
        yield k, before, False
        before = block
    yield -1, before, True


_HITS = "doc_id long, text string, hits binary, items array<string>"


def _scan(patterns, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = patterns.value
        for b in slices(batches):
            w = words(b.column(1), ALNUM)
            n_docs = b.num_rows
            doc_of = w.doc_of_word()
            delta = np.zeros(len(w.hashes) + 1, np.int64)
            items: list[set[str]] = [set() for _ in range(n_docs)]
            if b.num_columns > 2:
                for i, (hits, found) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                    items[i].update(found)
                    for s, e in np.frombuffer(hits, np.int64).reshape(-1, 2) + w.first[i]:
                        delta[s] += 1
                        delta[e] -= 1
            for p in compiled:
                for at, s in p.search(w):
                    delta[at] += 1
                    delta[at + p.m] -= 1
                    items[doc_of[at]].update(p.strings[s])
            hit = np.cumsum(delta[:-1]) > 0
            if last:
                n_hit = np.bincount(doc_of[hit], minlength=n_docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0), pa.array(np.diff(w.first)), pa.array(n_hit.astype(np.int64)), pa.array([len(x) for x in items], pa.int64()),
                        pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]), pa.array(n_hit > 0),
                    ],
                    names=[c.split()[0] for c in SCHEMA.split(", ")],
                )
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
            cut: list[list[tuple[int, int]]] = [[] for _ in range(n_docs)]
            for s, e in edge.reshape(-1, 2):  # a run may go on into the next document
                while s < e:
                    d = doc_of[s]
                    stop = min(e, w.first[d + 1])
                    cut[d].append((s - w.first[d], stop - w.first[d]))
                    s = stop
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([np.array(x, np.int64).tobytes() for x in cut], pa.binary()), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                names=["doc_id", "text", "hits", "items"],
            )

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: the words and items of the benchmark that it holds."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    out = narrow(docs, "doc_id", "text")
    for k, block, last in numbered(blocks_of(benchmark)):
        patterns = spark.sparkContext.broadcast(compile_patterns(block))
        out = out.mapInArrow(_scan(patterns, last), SCHEMA if last else _HITS)
        if not last:
            out = scratch.save(out, f"hits{k}")
            patterns.unpersist()
            scratch.drop(f"hits{k - 1}")
    return out


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, by the verdicts of :func:`decontaminate`; same columns.

    Nothing is shuffled: the rows travel through the search of each block and the hit ones stay behind.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    columns = docs.columns
    rest = [c for c in columns if c != "text"]

    def kept(search):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                (verdict,) = search(iter([pa.RecordBatch.from_arrays([b.column(0), b.column(1).fill_null("")], names=["doc_id", "text"])]))
                clean = pa.array(~np.asarray(verdict.column("contaminated")))
                out = dict(zip(rest, b.column(2).flatten(), strict=True)) | {"text": b.column(1)}
                yield pa.RecordBatch.from_arrays([out[c] for c in columns], names=columns).filter(clean)

        return run

    scratch = Scratch(spark, "uncontaminated")
    out = docs
    for k, block, last in numbered(blocks_of(benchmark)):
        patterns = spark.sparkContext.broadcast(compile_patterns(block))
        ready = out.select(F.lit(0).cast("long").alias("key"), "text", F.struct(*rest).alias("row"))  # any names go in the struct; the text travels once
        out = ready.mapInArrow(kept(_scan(patterns, True)), docs.schema)
        if not last:
            out = scratch.save(out, f"kept{k}")
            patterns.unpersist()
            scratch.drop(f"kept{k - 1}")
    return out
