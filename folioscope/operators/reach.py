"""All paths of each record's graph in one shuffle: cycles condensed, then sets of reachable nodes as bit vectors, sinks first.

A record's edges are one row, a list of number pairs; what it reaches is as long as its answer. Records of more than ``WIDE`` edges, for which one row is too much, go by
doubling joins over the whole cluster instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Edges of a record that goes by bit vectors, and nodes whose paths are given out at once.
WIDE, SOURCES = 200_000, 256


def components(n: int, edges: np.ndarray) -> list[list[int]]:
    """Strongly connected components of the nodes 0 .. n - 1, every component after all that it reaches."""
    order = np.argsort(edges[:, 0], kind="stable")
    target = edges[order, 1].tolist()
    first = np.searchsorted(edges[order, 0], np.arange(n + 1)).tolist()
    index, low, on, stack, out = [-1] * n, [0] * n, [False] * n, [], []
    count = 0
    for root in range(n):
        if index[root] >= 0:
            continue
        path = [(root, first[root])]
        while path:
            v, at = path.pop()
            if at == first[v] and index[v] < 0:
                index[v] = low[v] = count
                count += 1
                stack.append(v)
                on[v] = True
            if at < first[v + 1]:
                path.append((v, at + 1))
                w = target[at]
                if index[w] < 0:
                    path.append((w, first[w]))
                elif on[w]:
                    low[v] = min(low[v], index[w])
                continue
            if path:
                up = path[-1][0]
                low[up] = min(low[up], low[v])
            if low[v] == index[v]:
                mine = []
                while not mine or mine[-1] != v:
                    mine.append(stack.pop())
                    on[mine[-1]] = False
                out.append(mine)
    return out


def reachable(n: int, edges: np.ndarray) -> list[int]:
    """For each node the nodes that a path of one edge or more leads to, as the bits of a number."""
    after: list[set[int]] = [set() for _ in range(n)]
    for a, b in edges.tolist():
        after[a].add(b)
    reach = [0] * n
    for members in components(n, edges):
        inside = set(members)
        bits = 0
        for v in members:
            for w in after[v]:
                bits |= 1 << w if w in inside else 1 << w | reach[w]
        if len(members) > 1:
            bits |= sum(1 << v for v in members)
        for v in members:
            reach[v] = bits
    return reach


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            n, xs = batch.column(1)[i].as_py(), batch.column(2)[i].values
            edges = np.stack([xs.field(k).to_numpy() for k in ("a", "b")], axis=1).astype(np.int64)
            reach = reachable(n, edges)
            for at in range(0, n, SOURCES):
                found = [np.flatnonzero(np.unpackbits(np.frombuffer(bits.to_bytes((n + 7) // 8, "little"), np.uint8), bitorder="little")) for bits in reach[at : at + SOURCES]]
                a = np.repeat(np.arange(at, at + len(found)), [len(f) for f in found])
                if len(a):
                    same = batch.column(0).take(pa.array(np.full(len(a), i)))
                    yield pa.RecordBatch.from_arrays([same, pa.array(a.astype(np.int32)), pa.array(np.concatenate(found).astype(np.int32))], names=["_record", "_a", "_b"])


def narrow_closure(edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, a, b) with a path from a to b, of (keys, a, b) edges without nulls."""
    ends = edges.select(*keys, F.explode(F.array("a", "b")).alias("v")).distinct()
    ids = ends.withColumn("_id", (F.row_number().over(Window.partitionBy(*keys).orderBy("v")) - 1).cast("int"))
    named = lambda c, i: ids.select(*keys, F.col("v").alias(c), F.col("_id").alias(i))
    numbers = edges.join(named("a", "_a"), [*keys, "a"]).join(named("b", "_b"), [*keys, "b"])
    rows = numbers.groupBy(*keys).agg(F.collect_list(F.struct(F.col("_a").alias("a"), F.col("_b").alias("b"))).alias("edges")).withColumn("n", F.array_max(F.transform("edges", lambda x: F.greatest(x["a"], x["b"]))) + 1)
    ready = rows.select(F.struct(*keys).alias("_record"), "n", "edges")
    shape = f"_record {ready.schema['_record'].dataType.simpleString()}, _a int, _b int"
    pairs = ready.mapInArrow(_paths, shape).select(*[F.col(f"_record.{k}").alias(k) for k in keys], "_a", "_b")
    return pairs.join(named("a", "_a"), [*keys, "_a"]).join(named("b", "_b"), [*keys, "_b"]).select(*keys, "a", "b")
