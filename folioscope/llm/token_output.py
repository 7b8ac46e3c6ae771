"""Operator 9, token-ID output: materialised training order.

Documents become sequences of at most ``STRIDE`` ids (each document's ids, then the end id, cut from its start). A keyed Feistel network on the
smallest domain of an even number of bits permutes 0 .. n-1, walking each cycle until it is inside again, so every sequence has a global slot that
needs no table. Slots are dealt by range; each range's task writes whole shards of ``SHARD_SLOTS`` slots, every slot ``STRIDE`` ids
wide and padded with 0, so the k-th sequence of the training order is at shard k // SHARD_SLOTS, byte (k % SHARD_SLOTS) * STRIDE * width: reading
is sequential and resumes anywhere.

Sequences are numbered by the task that wrote them and their place in it; the table of a task's first number has one row a task.
A shard is written under a name of its own and renamed, with the same bytes each time, so a lost or repeated task does no harm.

Defined cases: null and empty texts are the end id alone; a long text has as many sequences as it needs; a null doc_id reads back as -1; repeated
rows are separate sequences; no two sequences tie for a slot; an empty table writes no shard; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch, narrow, partitions, slices
from .subwords import WordBpe
from .wordhash import mix

STRIDE, SHARD_SLOTS, END, KEY, ROUNDS = 256, 16_384, 1, 0x5EED, 6
#: First numbers of up to so many tasks (12 bytes each) are broadcast; beyond, the packs are joined by shuffle.
BROADCAST_TASKS = 500_000
#: A range has so many shards at most (64 MB), whatever the corpus; a writing task gets so many ranges at most, one after the other.
RANGE_SHARDS, TASK_RANGES = 8, 64
#: So few ids are not worth compressing: with many ranges a pack holds a sequence or two.
RAW_IDS = 1024
_MANIFEST = "slot long, shard long, byte_offset long, doc_id long, piece int, n_tokens int"
SCHEMA = _MANIFEST + ", ids_crc32 long"


def feistel(index: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The slots of the indices: a permutation of 0 .. n-1."""
    half = np.uint64(max(1, -(-max(n - 1, 1).bit_length() // 2)))
    low = np.uint64((1 << int(half)) - 1)
    keys = mix(np.arange(ROUNDS, dtype=np.uint64) + np.uint64(key * 0x9E3779B97F4A7C15 % 2**64))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & low
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & low)
        return left << half | right

    out = once(index.astype(np.uint64))
    outside = np.flatnonzero(out >= n)
    while len(outside):
        out[outside] = once(out[outside])
        outside = outside[out[outside] >= n]
    return out.astype(np.int64)


def _squeeze(ids: np.ndarray) -> bytes:
    """Compressed 16-bit ids: the distinct ones by falling frequency, then the low and the high bytes of each id's rank among them; few ids as they are."""
    if len(ids) <= RAW_IDS:
        return ids.astype("<u2").tobytes()
    counts = np.bincount(ids, minlength=1 << 16)
    kinds = np.flatnonzero(counts)
    kinds = kinds[np.argsort(-counts[kinds], kind="stable")]
    rank = np.zeros(1 << 16, "<u2")
    rank[kinds] = np.arange(len(kinds))
    low, high = (pa.compress(np.ascontiguousarray(p).tobytes(), codec="zstd", asbytes=True) for p in rank[ids].view(np.uint8).reshape(-1, 2).T)
    return b"".join((np.array([len(kinds), len(low)], "<u4").tobytes(), kinds.astype("<u2").tobytes(), low, high))


def _expand(blob: bytes, n: int) -> np.ndarray:
    if n <= RAW_IDS:
        return np.frombuffer(blob, "<u2", n)
    n_kinds, n_low = np.frombuffer(blob, "<u4", 2).tolist()
    kinds = np.frombuffer(blob, "<u2", n_kinds, 8)
    at = 8 + 2 * n_kinds
    low, high = (np.frombuffer(pa.decompress(x, n, codec="zstd", asbytes=True), np.uint8) for x in (blob[at : at + n_low], blob[at + n_low :]))
    return kinds[low.astype(np.int64) | high.astype(np.int64) << 8]


def _sequences(vocabulary: str, stride: int):
    """Packs of a task's sequences: their documents, pieces, lengths and ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe.shared(vocabulary)
        task, at = TaskContext.get().partitionId(), 0
        for b in slices(batches):
            ids = [np.append(np.frombuffer(x, np.uint32), np.uint32(END)) for x in bpe.encode(b.column(1).to_pylist())]
            size = np.array([len(x) for x in ids])
            flat = np.concatenate(ids)
            if int(flat.max()) > 0xFFFF:
                raise ValueError("this vocabulary's ids do not fit 16 bits")
            n = -(-size // stride)
            doc = np.repeat(b.column(0).fill_null(-1).to_numpy(), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            length = np.minimum(np.repeat(size, n) - piece * stride, stride)
            blob = b"".join((doc.astype(np.int64).tobytes(), piece.astype(np.int32).tobytes(), length.astype(np.int32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([at], pa.int64()), pa.array([len(doc)], pa.int64()), pa.array([len(flat)], pa.int64()), pa.array([blob], pa.binary()), pa.array([_squeeze(flat)], pa.binary())], names=["task", "at", "n", "n_ids", "meta", "ids"])
            at += len(doc)

    return run


def _meta(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(blob, np.int64, n), np.frombuffer(blob, np.int32, n, 8 * n), np.frombuffer(blob, np.int32, n, 12 * n)


def _deal(total: int, span: int, key: int):
    """A pack's sequences by range of slots: (range, slots, documents, pieces, lengths, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, n, n_ids, meta, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
                doc, piece, length = _meta(meta, n)
                flat = _expand(ids, n_ids)
                begin = np.cumsum(length) - length
                slot = feistel(first + np.arange(n), total, key)
                order = np.argsort(slot)
                edges = np.flatnonzero(np.diff(slot[order] // span, prepend=-1, append=-1))
                rows = []
                for s, e in zip(edges[:-1], edges[1:], strict=True):
                    pick = order[s:e]
                    take = length[pick]
                    where = np.repeat(begin[pick] - np.cumsum(take) + take, take) + np.arange(take.sum())
                    head = b"".join((doc[pick].tobytes(), piece[pick].tobytes(), take.tobytes(), slot[pick].tobytes()))
                    rows.append((int(slot[pick[0]] // span), len(pick), int(take.sum()), head, _squeeze(flat[where])))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.binary())], names=["range", "n", "n_ids", "meta", "ids"])

    return run


def _write(root: str, total: int, span: int, stride: int, per_shard: int):
    """Whole shards of each range, and the manifest's rows. The rows come sorted by range, of which one is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        store.create_dir(base, recursive=True)
        packs = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for k, mine in groupby(packs, itemgetter(0)):
            begin, end = k * span, min((k + 1) * span, total)
            place = np.zeros((end - begin, stride), "<u2")
            rows = []
            for _, n, n_ids, meta, ids in mine:
                doc, piece, length = _meta(meta, n)
                slot = np.frombuffer(meta, np.int64, n, 16 * n)
                row = np.repeat(slot - begin, length)
                column = np.arange(n_ids) - np.repeat(np.cumsum(length) - length, length)
                place[row, column] = _expand(ids, n_ids)
                rows.append((slot, doc, piece, length))
            for at in range(begin, end, per_shard):
                shard = at // per_shard
                temporary = f"{base}/.{uuid.uuid4().hex}"
                with store.open_output_stream(temporary) as out:
                    out.write(place[at - begin : at - begin + per_shard].tobytes())
                store.move(temporary, f"{base}/{shard:012d}.ids")
            slot, doc, piece, length = (np.concatenate(x) for x in zip(*rows, strict=True))
            order = np.argsort(slot)
            slot = slot[order]
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(slot // per_shard), pa.array(slot % per_shard * stride * 2), pa.array(doc[order]), pa.array(piece[order]), pa.array(length[order])], names=[c.split()[0] for c in _MANIFEST.split(", ")])

    return run


def write_shards(docs: DataFrame, vocabulary: str, scratch: Scratch, stride: int = STRIDE, per_shard: int = SHARD_SLOTS, key: int = KEY) -> tuple[DataFrame, str]:
    """The manifest (a row for each sequence) and the folder of the shards."""
    spark = docs.sparkSession
    width = partitions(spark)
    packs = scratch.save(narrow(docs, "doc_id", "text").mapInArrow(_sequences(vocabulary, stride), "task int, at long, n long, n_ids long, meta binary, ids binary"), "packs")
    tasks = packs.groupBy("task").agg(F.sum("n").alias("n"))
    total = tasks.agg(F.sum("n")).first()[0] or 0
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    firsts = tasks.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    if tasks.count() <= BROADCAST_TASKS:
        firsts = F.broadcast(firsts)
    # a range is some whole shards, small enough that the tasks get several each, and of bounded size
    span = per_shard * min(RANGE_SHARDS, max(1, -(-total // (per_shard * 4 * width))))
    width = max(width, -(-total // (span * TASK_RANGES)))
    dealt = packs.join(firsts, "task").select((F.col("first") + F.col("at")).alias("first"), "n", "n_ids", "meta", "ids").mapInArrow(_deal(total, span, key), "range long, n long, n_ids long, meta binary, ids binary")
    root = f"{scratch.base}/shards"
    manifest = scratch.save(dealt.repartition(width, "range").sortWithinPartitions("range").mapInArrow(_write(root, total, span, stride, per_shard), _MANIFEST), "manifest")
    scratch.drop("packs")
    return manifest, root


def read_shards(manifest: DataFrame, root: str, stride: int = STRIDE) -> DataFrame:
    """The manifest with the checksum of each sequence's ids (as 32-bit little-endian), read from the shards in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        name, source = None, None
        for b in batches:
            sums = []
            for shard, offset, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(5).to_pylist(), strict=True):
                if shard != name:
                    if source is not None:
                        source.close()
                    name, source = shard, store.open_input_stream(f"{base}/{shard:012d}.ids", buffer_size=1 << 20)
                    at = 0
                if offset != at:
                    source.read(offset - at)
                sums.append(zlib.crc32(np.frombuffer(source.read(2 * stride), "<u2")[:n].astype("<u4").tobytes()))
                at = offset + 2 * stride
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sums, pa.int64())], names=[c.split()[0] for c in SCHEMA.split(", ")])

    placed = manifest.repartitionByRange(partitions(manifest.sparkSession), "slot").sortWithinPartitions("slot")
    return placed.mapInArrow(run, SCHEMA)


def training_order(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per sequence of the written shards."""
    manifest, root = write_shards(docs, vocabulary, Scratch(docs.sparkSession, "token-output"))
    return read_shards(manifest, root)
