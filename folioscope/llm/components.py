"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouped minimum and an equi-join, so a node with very many neighbours costs rows, never a list in one task.
The table is written to the shared folder after each round, which keeps the lineage short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def _minimum(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _stars(edges: DataFrame) -> bool:
    """Every node hangs on one smaller node, which hangs on none: the edges are the components."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.agg(F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0] == 0


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``edges`` has the long columns a and b; gives (node, component), the component being its smallest node.

    Nodes without an edge to another node are not listed.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now = scratch.save(now, f"{name}-0")
    k = 0
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _minimum(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = _minimum(large)
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        k += 1
        now = scratch.save(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
