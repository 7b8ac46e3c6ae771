"""Operator 2, n-gram Jaccard join: a token-group matrix.

Documents are sets of distinct five-word shingles ("tokens", 64-bit hashes); two link at a Jaccard similarity of 0.75 or more.

1. Equal sets collapse to one representative by a 128-bit signature; only representatives go on.
2. In one order of all tokens, a set's prefix is long enough that linked sets share at least a known number of
   prefix tokens. Prefixes are dealt by token in packed arrays; only tokens that two sets hold come back. A set with too few of
   them can have no partner. The sets that are left are dealt whole in the same way: the tokens of all of them together bound what
   a set can share with any one, so a set with less than 0.75 n of them goes too. Of the others, the rarest few tokens are the index.
3. Each indexed set is compared with the smallest and the largest key that share a token with it. Verified links give first components.
4. Groups: sets that share a token with another component are grouped by the commonest token of their index, which brings similar ones
   together, and each group is cut into rows of about ``GROUP_TOKENS`` tokens. A row is a matrix of its tokens' union and its members.
5. A token of the index pairs a query set with the group rows that hold it. The query's overlap with a row's union bounds its similarity to
   every member; only qualifying rows are opened, and then the matrix gives the overlap with all members at once. Components that a row
   has linked once need no second link.

A token, group or row of the matrix that very many sets share is dealt with by many tasks: what is known of it is broadcast (fewer than
``BROADCAST_IDS`` keys can have more than that fraction of all rows) or repeated for each salt, and its sets stay where they are or are salted.

No pair within a group is made, so copies cost rows in proportion to their number; no candidate is capped. Rarity by document
frequency keeps tokens that a great many documents share (licences, common passages) out of the index, but for sets that consist of them.

Tokens travel as 32 bits within a bucket of the hash. Tokens of one set that agree in them count as often as there are, so no bound falls short
and chance makes candidates, never loses links. Two different sets pass for one only if their 64-bit sums of mixed hashes agree.

Defined cases: null, empty and wordless texts have the empty set and stand alone; fewer than five words make one shingle; a text of any
length is one set; an empty table gives an empty one; a similarity of exactly 0.75 links; equal rows are each returned, as one class; a row
with a null doc_id belongs to the class of its equals that have one, and else has a null component and no near copies; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import Scratch, narrow, partitions, slices
from .wordhash import SPACE_FOLDED, mix, shingle_sets, words

WORDS, GROUP_TOKENS, FLUSH_TOKENS = 5, 65_536, 1 << 20
#: Up to so many representatives (8 bytes each) are broadcast to pick their texts; beyond, the texts are joined by shuffle.
BROADCAST_IDS = 500_000
#: A key with more rows than that is dealt to several tasks.
HOT_ROWS = 4096


def overlap_needed(n):
    """Tokens that a set of n must share with any partner: at least 0.75 n."""
    return (3 * n + 3) // 4


def prefix_extra(n):
    return np.maximum(1, n // 8)


def prefix_length(n):
    return n - overlap_needed(n) + prefix_extra(n)


#: SQL for the least number of shared prefix tokens of a set of n with any partner (which has overlap_needed(n) tokens at least).
_SHARED_AT_LEAST = "greatest(1, ((3 * n + 3) div 4) div 8)"
_OVERLAP_NEEDED = "((3 * n + 3) div 4)"


def _sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, set borders, sizes, and both halves of the signature."""
    tokens, first = shingle_sets(words(batch.column(1), SPACE_FOLDED), WORDS)
    n = np.diff(first)

    def total(x: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x, out=sums[1:])
        return sums[first[1:]] - sums[first[:-1]]

    return tokens, first, n, mix(total(mix(tokens))), mix(total(mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5))))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        _, _, n, one, two = _sets(b)
        yield pa.RecordBatch.from_arrays([b.column(0), _long(n), _long(one), _long(two)], names=["doc_id", "n", "key", "check"])


def _pack(held: list[tuple], buckets: int) -> pa.RecordBatch:
    """(keys, sizes, tokens, tokens of each set) parts, packed by bucket of the token.

    Within a bucket 32 bits of the hash stand for a token: two that agree in them by chance make a candidate more, and no link.
    """
    keys, sizes = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]).astype(np.uint32)
    tokens = np.concatenate([h[2] for h in held])
    owner = np.repeat(np.arange(len(keys), dtype=np.uint32), np.concatenate([h[3] for h in held]))
    bucket = (tokens >> np.uint64(40)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, tokens, owner = bucket[order], tokens[order], owner[order]
    edges = np.flatnonzero(np.diff(bucket, prepend=np.uint64(buckets), append=np.uint64(buckets)))
    names, blobs = [], []
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        used, at = np.unique(owner[s:e], return_inverse=True)
        head = np.array([len(used), e - s], np.uint32)
        blobs.append(b"".join(x.tobytes() for x in (head, keys[used], sizes[used], tokens[s:e].astype(np.uint32), at.astype(np.uint16 if len(used) < 65536 else np.uint32))))
        names.append(int(bucket[s]))
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "payload"])


def _whole(buckets: int):
    """All tokens of (key, n, tokens) rows, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            n = b.column(1).to_numpy()
            held.append((b.column(0).to_numpy().view(np.uint64), n, np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint64), n))
            n_held += int(n.sum())
            if n_held >= FLUSH_TOKENS:
                yield _pack(held, buckets)
                held, n_held = [], 0
        if held:
            yield _pack(held, buckets)

    return run


def _prefixes(buckets: int):
    """Prefix tokens of each distinct set of the task, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, n_held = [], 0
        for b in slices(batches):
            tokens, first, n, key, _ = _sets(b)
            fresh = []
            for i, k in enumerate(key.tolist()):
                if n[i] and k not in seen:
                    seen.add(k)
                    fresh.append(i)
            if not fresh:
                continue
            fresh = np.array(fresh)
            take = prefix_length(n[fresh])
            at = np.repeat(first[fresh] - np.cumsum(take) + take, take) + np.arange(take.sum())
            held.append((key[fresh], n[fresh], tokens[at], take))
            n_held += int(take.sum())
            if n_held >= FLUSH_TOKENS:
                yield _pack(held, buckets)
                held, n_held = [], 0
        if held:
            yield _pack(held, buckets)

    return run


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    docs, size = np.frombuffer(blob, np.uint32, 2).tolist()
    keys = np.frombuffer(blob, np.uint64, docs, 8)
    sizes = np.frombuffer(blob, np.uint32, docs, 8 + 8 * docs)
    tokens = np.frombuffer(blob, np.uint32, size, 8 + 12 * docs)
    owner = np.frombuffer(blob, np.uint16 if docs < 65536 else np.uint32, size, 8 + 12 * docs + 4 * size)
    return tokens, keys[owner], sizes[owner]


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens that two sets or more hold, with the number of those sets. The rows come sorted by bucket, of which one is held.

    A set may come from several tasks, each with all of its tokens of the bucket; those of one of them count, as often as they are there.
    """
    rows = ((k, x) for b in batches for k, x in zip(b.column(0).to_pylist(), b.column(1), strict=True))
    for bucket, mine in groupby(rows, itemgetter(0)):
        parts = [_unpack(x.as_py()) for _, x in mine]
        tokens, keys, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
        part = np.repeat(np.arange(len(parts)), [len(x[0]) for x in parts])
        order = np.lexsort((part, keys, tokens))
        tokens, keys, sizes, part = tokens[order], keys[order], sizes[order], part[order]
        fresh = np.ones(len(tokens), bool)
        fresh[1:] = (tokens[1:] != tokens[:-1]) | (keys[1:] != keys[:-1])
        mine_ = part == np.repeat(part[fresh], np.diff(np.append(np.flatnonzero(fresh), len(part))))
        tokens, keys, sizes, fresh = tokens[mine_], keys[mine_], sizes[mine_], fresh[mine_]
        start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        df = np.repeat(np.add.reduceat(fresh, start, dtype=np.int64), np.diff(np.append(start, len(tokens))))
        many = df > 1
        tokens = tokens.astype(np.uint64) | np.uint64(bucket << 32)
        for at in range(0, int(many.sum()), 100_000):
            cut = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([_long(keys[many][cut]), _long(sizes[many][cut]), _long(tokens[many][cut]), _long(df[many][cut])], names=["key", "n", "token", "df"])


def _token_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        tokens, first, n, key, _ = _sets(b)
        yield pa.RecordBatch.from_arrays([_long(key), _long(n), pa.array([tokens[s:e].tobytes() for s, e in zip(first[:-1], first[1:], strict=True)], pa.binary())], names=["key", "n", "tokens"])


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    if 4 * min(len(a), len(b)) < 3 * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = [_linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)) for x, y in zip(b.column(2), b.column(3), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep, pa.bool_())), b.column(1).filter(pa.array(keep, pa.bool_()))], names=["a", "b"])


class _Group:
    """A group row: the union of its members' tokens, and for each token the members that have it."""

    def __init__(self, members: list[tuple[int, int, np.ndarray]]):
        self.keys, self.parts = [m[0] for m in members], [m[1] for m in members]
        self.size = np.array([len(m[2]) for m in members])
        tokens = np.concatenate([m[2] for m in members])
        order = np.argsort(tokens, kind="stable")
        self.owner = np.repeat(np.arange(len(members)), self.size)[order]
        self.union, self.start = np.unique(tokens[order], return_index=True)
        self.stop = np.append(self.start[1:], len(tokens))
        self.root: dict[int, int] = {}

    def find(self, part: int) -> int:
        while self.root.setdefault(part, part) != part:
            self.root[part] = self.root[self.root[part]]
            part = self.root[part]
        return part

    def links(self, key: int, part: int, q: np.ndarray) -> Iterator[tuple[int, int]]:
        """A link for each other component of the row that the query links to, unless the row has joined them already."""
        at = np.minimum(np.searchsorted(self.union, q), len(self.union) - 1)
        at = at[self.union[at] == q]
        if len(at) < overlap_needed(len(q)):
            return
        n = self.stop[at] - self.start[at]
        owners = self.owner[np.repeat(self.start[at] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
        common = np.bincount(owners, minlength=len(self.size))
        for m in np.flatnonzero(100 * common >= 75 * (len(q) + self.size - common)).tolist():
            a, b = self.find(part), self.find(self.parts[m])
            if a != b:
                self.root[b] = a
                yield key, self.keys[m]


def _open_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the queries of each group row; a row's members come first, then its queries, one at a time."""
    now, members, group = None, [], None
    for b in batches:
        links = []
        for *at, query, key, part, blob in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if at != now:
                now, members, group = at, [], None
            tokens = np.frombuffer(blob, np.uint64)
            if not query:
                members.append((key, part, tokens))
                continue
            if group is None:
                group = _Group(members)
            links += group.links(key, part, tokens)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([x for _, x in links], pa.int64())], names=["a", "b"])


def join_skewed(rows: DataFrame, facts: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with the ``facts`` of their key; a row of ``facts`` is a key and its number of rows, ``df``.

    Keys of many rows are joined by broadcast, so that their rows are not dealt by key. More than one in ``BROADCAST_IDS`` of all rows
    can be had by fewer than ``BROADCAST_IDS`` keys only.
    """
    n, most = facts.agg(F.sum("df"), F.max("df")).first()
    least = max(HOT_ROWS, (n or 0) // BROADCAST_IDS)
    if (most or 0) <= least:
        return rows.join(facts, on)
    hot, cold = facts.where(F.col("df") > least), facts.where(F.col("df") <= least)
    return rows.join(F.broadcast(hot), on).unionByName(rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on))


def salts(df: str):
    """Tasks for a key of so many rows."""
    return F.ceil(F.col(df) / HOT_ROWS).cast("int")


def _matrix_links(placed: DataFrame, sets: DataFrame, scratch: Scratch, width: int) -> DataFrame:
    """Links between components: ``placed`` has the (token, df, key, n, grp) index rows of tokens that more than one component holds."""
    home = scratch.save(placed.groupBy("key", "n", "grp").agg(F.max_by("token", F.struct("df", "token")).alias("g")), "homes")
    rows = scratch.save(home.groupBy("g").agg(F.ceil(F.sum("n") / GROUP_TOKENS).alias("rows"), F.count(F.lit(1)).alias("df")), "rows")
    home = scratch.save(join_skewed(home, rows, ["g"]).select("key", "grp", "g", F.pmod(F.xxhash64("key"), F.col("rows")).alias("p")), "home")
    matrix = placed.join(home.select("key", "g", "p"), "key").select("token", "df", "g", "p").distinct()
    matrix = matrix.withColumn("salt", F.explode(F.sequence(F.lit(0), salts("df") - 1))).drop("df")
    asked = placed.withColumn("salt", F.pmod(F.xxhash64("key"), salts("df")).cast("int"))
    cells = scratch.save(asked.join(matrix, ["token", "salt"]).select("key", "grp", "g", "p").distinct(), "cells")
    load = scratch.save(cells.groupBy("g", "p").agg(F.count(F.lit(1)).alias("df")), "load")
    order = ["g", "p", "salt", "query", "key", "grp", "tokens"]
    members = home.join(load, ["g", "p"]).withColumn("salt", F.explode(F.sequence(F.lit(0), salts("df") - 1)))
    queries = join_skewed(cells, load, ["g", "p"]).withColumn("salt", F.pmod(F.xxhash64("key"), salts("df")).cast("int"))
    members = members.join(sets, "key").withColumn("query", F.lit(0)).select(*order)
    queries = queries.join(sets, "key").withColumn("query", F.lit(1)).select(*order)
    both = members.unionByName(queries).repartition(width, "g", "p", "salt").sortWithinPartitions("g", "p", "salt", "query", "key")
    return both.mapInArrow(_open_groups, "a long, b long")


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram-join")
    width = partitions(spark)
    texts = narrow(docs, "doc_id", "text")

    signatures = scratch.save(texts.mapInArrow(_signatures, "doc_id long, n long, key long, check long"), "signatures")
    classes = scratch.save(signatures.where("n > 0").groupBy("key", "check", "n").agg(F.min("doc_id").alias("rep")), "classes")

    def common(dealt: DataFrame) -> DataFrame:
        found = dealt.repartition(width, "bucket").sortWithinPartitions("bucket").mapInArrow(_common, "key long, n long, token long, df long")
        return found.groupBy("key", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("found"))

    hopeful = common(texts.mapInArrow(_prefixes(4 * width), "bucket int, payload binary")).where(f"size(found) >= {_SHARED_AT_LEAST}")
    hopeful = scratch.save(hopeful.select("key"), "hopeful")
    ids = scratch.save(classes.join(hopeful, "key", "left_semi").select(F.col("rep").alias("doc_id")).distinct(), "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    sets = texts.join(ids, "doc_id", "left_semi").mapInArrow(_token_sets, "key long, n long, tokens binary")
    sets = scratch.save(sets.where("n > 0").join(hopeful, "key", "left_semi").dropDuplicates(["key"]), "sets")

    by_set = common(sets.mapInArrow(_whole(4 * width), "bucket int, payload binary")).where(f"size(found) >= {_OVERLAP_NEEDED}")
    rare = by_set.select("key", "n", F.explode(F.expr(f"slice(found, 1, cast(size(found) - {_OVERLAP_NEEDED} + 1 as int))")).alias("x"))
    index = scratch.save(rare.select(F.col("x.token").alias("token"), "key", "n"), "index")
    sets = scratch.save(sets.join(index.select("key").distinct(), "key", "left_semi"), "indexed")
    scratch.drop("sets")

    # groups: links to the smallest and the largest key that share an indexed token
    ends = scratch.save(index.groupBy("token").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("df")).where("low < high"), "ends")
    near = join_skewed(index, ends, ["token"]).groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    pairs = near.select("key", F.explode(F.array("low", "high")).alias("other")).where("key <> other")
    pairs = pairs.select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).distinct()
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    sizes = pairs.join(left.select("a", "na"), "a").join(right.select("b", "nb"), "b").where("4 * least(na, nb) >= 3 * greatest(na, nb)").select("a", "b")
    links = sizes.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(_verify, "a long, b long")
    links = scratch.save(links, "links")
    grouped = scratch.save(components(links, scratch, "groups"), "grouped").withColumnRenamed("node", "key").withColumnRenamed("component", "grp")

    # the token-group matrix, for tokens that more than one group holds
    of_group = lambda df: df.join(grouped, "key", "left").withColumn("grp", F.coalesce("grp", "key"))
    placed = of_group(index)
    shared = placed.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high"), F.count(F.lit(1)).alias("df")).where("low < high")
    shared = scratch.save(shared.select("token", "df"), "shared")
    placed = scratch.save(join_skewed(placed, shared, ["token"]), "placed")
    final = grouped
    if not placed.isEmpty():
        more = scratch.save(_matrix_links(placed, sets, scratch, width), "more")
        final = scratch.save(components(links.unionByName(more), scratch, "final"), "components").withColumnsRenamed({"node": "key", "component": "grp"})
    keyed = classes.join(final, "key", "left").select("key", "check", "n", "rep", F.coalesce("grp", "key").alias("component"))
    smallest = keyed.groupBy("component").agg(F.min("rep").alias("component_id"))
    answer = scratch.save(keyed.join(smallest, "component").select("key", "check", "n", "component_id"), "answer")
    scratch.keep("signatures", "answer")
    out = signatures.join(answer, ["key", "check", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
