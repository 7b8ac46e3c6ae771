"""Nearest neighbours of stated queries: by an inverted file of centroids with exact distances, and exactly against all rows in blocks.

The index is fitted on at most ``SAMPLE`` vectors: centroids by plain k-means, and the number of lists to search by trying it on the sample until a share of ``AIM`` of the true
neighbours is found. Every vector is indexed. Lists are dealt to blocks of bounded size, and so are the queries that search them; each pair of blocks is one product of matrices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors of the fit; lists at most; the share of neighbours that the sample must find; rows and queries of a block.
SAMPLE, LISTS, AIM, BLOCK, QUERIES = 10_000, 1024, 0.96, 8192, 1024


def _clean(vectors: DataFrame, key: str, vector: str, dims: int) -> DataFrame:
    """(_id, _x) of vectors with ``dims`` finite components; the others are nobody's neighbours."""
    x = F.col(vector).cast("array<double>")
    whole = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return vectors.select(F.col(key).cast("long").alias("_id"), x.alias("_x")).where(F.col("_id").isNotNull() & (F.size("_x") == dims) & F.coalesce(whole, F.lit(False)))


def _matrix(column: pa.Array) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T, 0.0)


def _centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    centre = x[np.random.default_rng(7).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        of = _squares(x, centre).argmin(1)
        count = np.bincount(of, minlength=k)
        total = np.zeros_like(centre)
        np.add.at(total, of, x)
        centre[count > 0] = total[count > 0] / count[count > 0][:, None]
    return centre


def _searched(x: np.ndarray, centre: np.ndarray, top: int) -> int:
    """The fewest lists that find ``AIM`` of the sample's neighbours, on up to 300 of its vectors."""
    some = x[:: max(1, len(x) // 300)][:300]
    true = np.argsort(_squares(some, x), axis=1, kind="stable")[:, : top + 1]
    near = np.argsort(_squares(some, centre), axis=1, kind="stable")
    place = np.empty_like(near)
    np.put_along_axis(place, near, np.arange(len(centre))[None, :], axis=1)
    needed = np.take_along_axis(place, _squares(x, centre).argmin(1)[true], axis=1)
    for lists in range(1, len(centre)):
        if (needed < lists).mean() >= AIM:
            return lists
    return len(centre)


def _best(df: pd.DataFrame, top: int) -> pd.DataFrame:
    return df.sort_values(["query", "distance", "neighbour"]).groupby("query", sort=False).head(top)


def _top(found: DataFrame, top: int) -> DataFrame:
    """(query, rank, neighbour, distance): the nearest of what blocks have found, ties to the smaller id."""
    ranked = found.groupBy("query").agg(F.slice(F.array_sort(F.collect_set(F.struct("distance", "neighbour"))), 1, top).alias("xs"))
    return ranked.select("query", F.posexplode("xs").alias("rank", "x")).select("query", (F.col("rank") + 1).alias("rank"), "x.neighbour", "x.distance")


def _pairs(ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, top: int) -> pd.DataFrame:
    """The nearest ``top`` rows of a block for each query, itself excluded; all that tie with the last come along."""
    d = _squares(q, x)
    d[q_ids[:, None] == ids[None, :]] = np.inf
    k = min(top, len(ids)) - 1
    last = np.partition(d, k, axis=1)[:, k]
    i, j = np.nonzero((d <= last[:, None]) & np.isfinite(d))
    return _best(pd.DataFrame({"query": q_ids[i], "neighbour": ids[j], "distance": np.round(d[i, j], 12)}), top)


_FOUND = "query long, neighbour long, distance double"


def neighbours(vectors: DataFrame, queries: DataFrame, key: str, vector: str, dims: int, top: int = 10, block: int = BLOCK) -> DataFrame:
    """(query, rank, neighbour, distance): nearly all of the ``top`` nearest vectors of each query by squared distance. Ids are unique; repeated ones count as one."""
    spark = vectors.sparkSession
    rows = _clean(vectors, key, vector, dims)
    n = rows.count()
    at = F.pmod(F.xxhash64("_id"), F.lit(1 << 40))
    sample = rows.where(at < min(1 << 40, int(SAMPLE / max(n, 1) * (1 << 40)))).select("_x").orderBy("_x").limit(2 * SAMPLE).toArrow()  # about SAMPLE rows
    x = _matrix(sample.column("_x").combine_chunks()) if sample.num_rows else np.zeros((0, dims))
    if not len(x):
        return spark.createDataFrame([], "query long, rank int, neighbour long, distance double")
    centre = _centroids(x, max(1, min(LISTS, int(np.sqrt(n)), len(x))))
    lists = _searched(x, centre, top)
    shared = spark.sparkContext.broadcast(centre)  # at most LISTS vectors

    def dealt(many: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    near = np.argsort(_squares(_matrix(b.column(1)), shared.value), axis=1, kind="stable")[:, :many]
                    again = pa.array(np.repeat(np.arange(b.num_rows), near.shape[1]))
                    yield pa.RecordBatch.from_arrays([pa.array(near.ravel().astype(np.int32)), b.column(0).take(again), b.column(1).take(again)], names=["list", "_id", "_x"])

        return run

    shape = "list int, _id long, _x array<double>"
    data = rows.mapInArrow(dealt(1), shape)
    asked = _clean(queries, key, vector, dims).mapInArrow(dealt(lists), shape)
    size = lambda df, per, name: df.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / per).cast("int").alias(name))
    blocks = size(data, block, "_blocks").join(size(asked, QUERIES, "_parts"), "list")  # one row for each list
    own = lambda c, of: F.pmod(F.xxhash64("_id", F.lit(c)), F.col(of)).cast("int").alias(c)
    each = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    left = data.join(F.broadcast(blocks), "list").select("list", own("block", "_blocks"), each("_parts").alias("part"), "_id", "_x")
    right = asked.join(F.broadcast(blocks), "list").select(F.col("list").alias("q_list"), each("_blocks").alias("q_block"), own("part", "_parts"), F.col("_id").alias("q_id"), F.col("_x").alias("q_x")).withColumnRenamed("part", "q_part")

    def compare(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        if not mine.num_rows or not theirs.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "neighbour": pa.array([], pa.int64()), "distance": pa.array([], pa.float64())})
        found = _pairs(mine.column("_id").to_numpy(), _matrix(mine.column("_x").combine_chunks()), theirs.column("q_id").to_numpy(), _matrix(theirs.column("q_x").combine_chunks()), top)
        return pa.Table.from_pandas(found, preserve_index=False)

    met = left.groupBy("list", "block", "part").cogroup(right.groupBy("q_list", "q_block", "q_part")).applyInArrow(compare, _FOUND)
    return _top(met, top)


def exact_neighbours(vectors: DataFrame, queries: DataFrame, key: str, vector: str, dims: int, top: int = 10) -> DataFrame:
    """The same, all of them: the queries go out in blocks of ``QUERIES``, each one narrow pass over all vectors."""
    spark = vectors.sparkSession
    rows, asked = _clean(vectors, key, vector, dims), _clean(queries, key, vector, dims)
    blocks = max(1, -(-asked.count() // QUERIES))
    out = None
    for k in range(blocks):
        one = asked.where(F.pmod(F.xxhash64("_id"), F.lit(blocks)) == k).toArrow()
        shared = spark.sparkContext.broadcast((one.column("_id").to_numpy(), _matrix(one.column("_x").combine_chunks()) if one.num_rows else np.zeros((0, dims))))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, q = shared.value
            for b in batches:
                if b.num_rows and len(ids):
                    yield pa.RecordBatch.from_pandas(_pairs(b.column(0).to_numpy(), _matrix(b.column(1)), ids, q, top), preserve_index=False)

        found = rows.mapInArrow(run, _FOUND)
        out = found if out is None else out.unionByName(found)
    return _top(out, top)
