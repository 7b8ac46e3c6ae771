"""Centroid clustering: dual-tree Lloyd over integer vectors, exact to the last unit.

Vectors are packed, where they lie, into blocks of ``BLOCK`` rows, and each block gets a cover tree once: the children of a node are
points more than half its radius apart that cover it, so copies share one node of radius 0. In each round the few centroids get a tree of the same kind, and
a block walks both trees together: a pair of nodes is dropped when no centroid under the one can be nearest to any vector under the other. A node that
one centroid is left for goes to it whole, by sums kept along the tree's order; what is left at leaves is compared in exact integers. A round shuffles 65 numbers
per centroid and task, and the driver holds the centroids alone.

Kept are vectors of exactly ``dims`` finite components; an empty table, or one without such vectors, gives no rows, and fewer vectors than centroids give
one centroid each. Rows that repeat count each time; a null ``vec_id`` stays null and starts no cluster unless too few others do. Components beyond 2^62 in size
count as 2^62, and distances and sums beyond a long as the largest long. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: Vectors of a block, and of a leaf.
BLOCK, LEAF = 1024, 16
#: Up to this size of a component, sums of 64 squares are exact in doubles; beyond it a block is compared in Python integers.
EXACT, FAR, LONG = 1 << 22, 1 << 62, (1 << 63) - 1
_NODE = np.dtype([("pivot", "<i4"), ("first", "<i4"), ("last", "<i4"), ("down", "<i4"), ("up", "<i4"), ("radius", "<f8")])


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all of ``b``; exact, as whole numbers, up to components of ``EXACT``."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T), 0.0)


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(order, nodes): nodes lie level by level, each over a slice of the points in ``order``, its children one after another.

    A node's children are greedy centres: its pivot first, then each next point that lies more than half the radius from all before.
    """
    distance = np.sqrt(squares(points, points))
    order = np.arange(len(points))
    nodes = []
    todo = [(0, len(points))] if len(points) else []
    while todo:
        coming: list[tuple[int, int]] = []
        base = len(nodes) + len(todo)
        for first, last in todo:
            mine = order[first:last].copy()
            away = distance[mine[0], mine]
            radius = float(away.max())
            down = up = 0
            if last - first > leaf and radius > 0:
                down = base + len(coming)
                at, rest = first, mine
                while len(rest):
                    near = distance[rest[0], rest] * 2.0 <= radius
                    group = rest[near]
                    order[at : at + len(group)] = group
                    coming.append((at, at + len(group)))
                    at += len(group)
                    rest = rest[~near]
                up = base + len(coming)
            nodes.append((first, first, last, down, up, radius))
        todo = coming
    return order, np.array(nodes, _NODE)


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers first[i] .. last[i] - 1 of all i, end to end."""
    many = last - first
    return np.repeat(first - np.cumsum(many) + many, many) + np.arange(int(many.sum()))


def nearest(points: np.ndarray, nodes: np.ndarray, centroids: np.ndarray, tree: tuple[np.ndarray, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first, last, cluster) slices of the points, which cover them all: the nearest centroid of each, ties to the smaller number.

    ``bound`` holds for each vector node the distance within which some centroid is sure to be from all its vectors.
    """
    c_order, c_nodes = tree
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    v, c = np.zeros(1, np.int64), np.zeros(1, np.int64)
    bound = np.full(len(nodes), np.inf)
    while len(v):
        wide, c_wide = nodes["radius"][v], c_nodes["radius"][c]
        live, slot = np.unique(v, return_inverse=True)
        d = np.sqrt(squares(points[nodes["pivot"][live]], centroids[c_order[c_nodes["pivot"]]])[slot, c])
        np.minimum.at(bound, v, d + wide)
        slack = 1e-9 * (1.0 + d)
        keep = d - wide - c_wide <= bound[v] + slack
        v, c, wide, c_wide = v[keep], c[keep], wide[keep], c_wide[keep]
        inner = c_nodes["up"][c] > c_nodes["down"][c]
        n_pairs, n_inner = np.bincount(v, minlength=len(nodes)), np.bincount(v[inner], minlength=len(nodes))
        alone = (n_pairs[v] == 1) & ~inner
        found.append((nodes["first"][v[alone]], nodes["last"][v[alone]], c_order[c_nodes["pivot"][c[alone]]]))
        bottom = nodes["up"][v] == nodes["down"][v]
        # leaf pairs: single centroids against the vectors of a leaf
        exact = ~alone & bottom & (n_inner[v] == 0)
        if exact.any():
            at = np.unique(v[exact])
            same = nodes["radius"][at] == 0
            rows = np.concatenate([nodes["first"][at[same]], _ranges(nodes["first"][at[~same]], nodes["last"][at[~same]])])
            ends = np.concatenate([nodes["last"][at[same]], _ranges(nodes["first"][at[~same]], nodes["last"][at[~same]]) + 1])
            found.append((rows, ends, squares(points[rows], centroids).argmin(1)))
        left = ~alone & ~exact
        # the wider side opens; a vector node waits until the centroid nodes it meets are smaller than itself
        opens = left & inner & ((c_wide >= wide) | bottom)
        waits = np.zeros(len(nodes), bool)
        waits[v[opens]] = True
        stay = left & ~opens & waits[v]
        falls = left & ~waits[v]
        down, up = c_nodes["down"][c[opens]], c_nodes["up"][c[opens]]
        v1, c1 = np.repeat(v[opens], up - down), _ranges(down, up)
        down, up = nodes["down"][v[falls]], nodes["up"][v[falls]]
        v2, c2 = _ranges(down, up), np.repeat(c[falls], up - down)
        bound[v2] = np.repeat(bound[v[falls]], up - down)
        v, c = np.concatenate([v1, v[stay], v2]), np.concatenate([c1, c[stay], c2])
    return found


def whole_numbers(flat: np.ndarray) -> np.ndarray:
    """floor(1024 * x), kept within 2^62."""
    return np.clip(np.floor(flat * 1024.0), -float(FAR), float(FAR)).astype(np.int64)


def _packed(dims: int):
    """A task's vectors as blocks, each with its tree."""

    def block(ids: pa.Array, q: np.ndarray) -> pa.RecordBatch:
        far = int(max(-int(q.min()), int(q.max())))
        order, nodes = cover_tree(q) if far <= EXACT else (np.arange(len(q)), np.zeros(0, _NODE))
        kind = next(t for t in (np.int16, np.int32, np.int64) if far <= np.iinfo(t).max)
        ids = ids.take(pa.array(order))
        sizes = [pa.array([x], pa.int32()) for x in (len(q), np.dtype(kind).itemsize)]
        whole = [pa.array([x.tobytes()], pa.binary()) for x in (q[order].astype(kind), nodes)]
        return pa.RecordBatch.from_arrays([*sizes, pa.ListArray.from_arrays(pa.array([0, len(q)], pa.int32()), ids), *whole], names=["n", "width", "ids", "q", "nodes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q, n = [], [], 0
        for b in batches:
            if not b.num_rows:
                continue
            ids.append(b.column(0))
            q.append(whole_numbers(pc.list_flatten(b.column(1)).to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, dims))
            n += b.num_rows
            if n >= BLOCK:
                all_ids, all_q = pa.concat_arrays(ids), np.concatenate(q)
                for at in range(0, n - n % BLOCK, BLOCK):
                    yield block(all_ids.slice(at, BLOCK), all_q[at : at + BLOCK])
                ids, q, n = [all_ids.slice(n - n % BLOCK)], [all_q[n - n % BLOCK :]], n % BLOCK
        if n:
            yield block(pa.concat_arrays(ids), np.concatenate(q))

    return run


def _blocks(batches: Iterator[pa.RecordBatch], dims: int):
    for b in batches:
        for i in range(b.num_rows):
            n, width, q, nodes = (b.column(k)[i] for k in (0, 1, 3, 4))
            kind = {2: np.int16, 4: np.int32, 8: np.int64}[width.as_py()]
            yield b.column(2)[i].values, np.frombuffer(q.as_buffer(), kind).reshape(n.as_py(), dims), np.frombuffer(nodes.as_buffer(), _NODE)


def _distances(q: np.ndarray, cluster: np.ndarray, centroids: list[list[int]]) -> list[int] | np.ndarray:
    own = np.array(centroids, np.int64)[cluster]
    if max(int(np.abs(q).max(initial=0)), int(np.abs(own).max(initial=0))) <= EXACT:
        return ((q.astype(np.int64) - own) ** 2).sum(1)
    return [min(LONG, sum((int(x) - y) ** 2 for x, y in zip(row, centroids[c], strict=True))) for row, c in zip(q, cluster, strict=True)]


def _clusters(q: np.ndarray, nodes: np.ndarray, centroids: list[list[int]], tree) -> np.ndarray:
    """The cluster of each of a block's vectors."""
    if not len(nodes) or tree is None:
        plain = [[int(x) for x in row] for row in q]
        return np.array([min((sum((x - y) ** 2 for x, y in zip(row, m, strict=True)), k) for k, m in enumerate(centroids))[1] for row in plain], np.int64)
    out = np.empty(len(q), np.int64)
    for first, last, cluster in nearest(q, nodes, np.array(centroids, np.int64), tree):
        out[_ranges(first, last)] = np.repeat(cluster, last - first)
    return out


def _tree_of(centroids: list[list[int]]):
    """The centroids' own tree; none without any, or if they are too far out for doubles."""
    if not centroids or any(abs(x) > EXACT for m in centroids for x in m):
        return None
    return _smallest_first(cover_tree(np.array(centroids, np.int64), leaf=1))


def _smallest_first(tree: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Equal centroids share a leaf of radius 0: the smallest number comes first and stands for all, as the others win no tie."""
    order, nodes = tree
    order = order.copy()
    for x in nodes[nodes["up"] == nodes["down"]]:
        order[x["first"] : x["last"]] = np.sort(order[x["first"] : x["last"]])
    return order, nodes


def _round(centroids: list[list[int]], dims: int):
    """(cluster, place, total) of a task: sums of components, and the count at place -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = _tree_of(centroids)
        k = len(centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), object)
        for _, q, nodes in _blocks(batches, dims):
            if len(nodes) and tree is not None:
                runs = np.concatenate([np.zeros((1, dims), np.int64), np.cumsum(q, axis=0, dtype=np.int64)])
                sums = np.zeros((k, dims), np.int64)
                for first, last, cluster in nearest(q, nodes, np.array(centroids, np.int64), tree):
                    np.add.at(sums, cluster, runs[last] - runs[first])
                    np.add.at(count, cluster, (last - first).astype(np.int64))
                total += sums
            else:
                cluster = _clusters(q, nodes, centroids, tree)
                np.add.at(count, cluster, 1)
                for c in np.unique(cluster):
                    total[c] += q[cluster == c].astype(object).sum(axis=0)
        places = [(c, j, int(total[c, j])) for c in np.flatnonzero(count) for j in range(dims)] + [(c, -1, int(count[c])) for c in np.flatnonzero(count)]
        if places:
            cs, js, xs = zip(*places, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(cs, pa.int32()), pa.array(js, pa.int32()), pa.array([str(x) for x in xs])], names=["cluster", "place", "total"])

    return run


def _assign(centroids: list[list[int]], dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = _tree_of(centroids)
        for ids, q, nodes in _blocks(batches, dims):
            cluster = _clusters(q, nodes, centroids, tree)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(_distances(q, cluster, centroids), pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


def kept_vectors(vectors: DataFrame, dims: int = 64) -> DataFrame:
    """(vec_id, embedding) of the vectors with ``dims`` finite components, as doubles."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")).where(F.col("embedding").isNotNull() & (F.size("embedding") == dims) & F.coalesce(finite, F.lit(False)))


def starts(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The first k vectors by the SHA-256 of ``seed:vec_id``; equal ids by their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select(key.alias("h"), "embedding").orderBy(F.col("h").asc_nulls_last(), "embedding").limit(k).collect()
    return [[int(x) for x in whole_numbers(np.array(r.embedding, np.float64))] for r in rows]


def lloyd(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "centroids")
    kept = kept_vectors(vectors, dims)
    blocks = scratch.save(kept.mapInArrow(_packed(dims), "n int, width int, ids array<long>, q binary, nodes binary"), "blocks")
    now = starts(kept, k, seed)
    for _ in range(rounds if now else 0):
        parts = blocks.mapInArrow(_round(now, dims), "cluster int, place int, total string")
        got: dict[int, dict[int, int]] = {}
        for r in parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
            got.setdefault(r.cluster, {})[r.place] = int(r.total)
        now = [[got[c][j] // got[c][-1] for j in range(dims)] if c in got else now[c] for c in range(len(now))]
    assigned = scratch.save(blocks.mapInArrow(_assign(now, dims), "vec_id long, cluster int, distance long"), "assigned")
    scratch.drop("blocks")
    inertia = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    sha = {c: hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for c, m in enumerate(now)}
    by_cluster = lambda of, kind: F.element_at(F.create_map(*[F.lit(x).cast(t) for c in inertia for x, t in ((c, "int"), (of(c), kind))]), F.col("cluster")) if inertia else F.lit(None).cast(kind)
    return assigned.select(
        "vec_id", "cluster", "distance", by_cluster(lambda c: min(LONG, inertia[c]), "long").alias("cluster_inertia"), F.lit(min(LONG, sum(inertia.values()))).cast("long").alias("inertia"), by_cluster(sha.get, "string").alias("centroid_sha256")
    )


def oracle(k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3) -> str:
    """The same in SQL, one pair of steps for each round; for components whose squares a long holds."""
    step = lambda r: (
        f"a{r} AS MATERIALIZED (SELECT rid, min(list_sum(list_transform(range(1, {dims + 1}), lambda i: (q[i] - m[i]) * (q[i] - m[i])))::BIGINT * {k} + c) AS x FROM v, c{r} GROUP BY rid)"
    )
    move = lambda r: (
        f"s{r} AS MATERIALIZED (SELECT x % {k} AS c, list_transform(range(1, {dims + 1}), lambda i: i) AS js, count(*) AS n, list(q) AS qs FROM v JOIN a{r} USING (rid) GROUP BY 1),\n"
        f"c{r + 1} AS MATERIALIZED (SELECT o.c, CASE WHEN n IS NULL THEN m ELSE list_transform(js, lambda j: ((list_sum(list_transform(qs, lambda y: y[j])) - ((list_sum(list_transform(qs, lambda y: y[j])) % n) + n) % n) // n)::BIGINT) END AS m FROM c{r} o LEFT JOIN s{r} USING (c))"
    )
    parts = [f"{step(r)},\n{move(r)}" for r in range(rounds)] + [step(rounds)]
    return f"""
WITH v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q AS m FROM (SELECT sha256('{seed}:' || vec_id) AS h, q FROM v ORDER BY h, q LIMIT {k})),
{''',
'''.join(parts)},
r AS (SELECT vec_id, x % {k} AS c, x // {k} AS distance FROM v JOIN a{rounds} USING (rid))
SELECT vec_id, c::INT AS cluster, distance::BIGINT AS distance, sum(distance) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM r JOIN c{rounds} USING (c)"""
