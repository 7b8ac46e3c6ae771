"""Closures over edge tables by semi-naive joins, with cycles kept harmless."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import reach


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage by a table in the session's checkpoint folder, whose size the optimizer then knows; where all of Spark is one process, as in tests, it may do without one."""
    spark = df.sparkSession
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return df.persist()
    path = f"{root.rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def doubled(edges: DataFrame, keys: list[str], most: int = 64) -> DataFrame:
    """All (keys, a, b) with a path from a to b, by joins: paths double in length each round, so rounds grow with the logarithm of the longest path."""
    paths = saved(edges.select(*keys, "a", "b").distinct())
    n = paths.count()
    for _ in range(most):
        longer = paths.alias("x").join(paths.select(*keys, F.col("a").alias("b"), F.col("b").alias("c")).alias("y"), [*keys, "b"]).select(*keys, "a", F.col("c").alias("b"))
        before, paths = paths, saved(paths.unionByName(longer).distinct())
        now = paths.count()
        before.unpersist()
        if now == n:
            break
        n = now
    return paths


def closure(edges: DataFrame, keys: list[str], source: str = "a", target: str = "b", wide: int = reach.WIDE) -> DataFrame:
    """All (keys, a, b) with a path from a to b. Records go by bit vectors in one shuffle; those of more than ``wide`` edges by doubling joins. Edges with a null, or of a null key, lead nowhere."""
    clean = edges.select(*keys, F.col(source).alias("a"), F.col(target).alias("b")).dropna().distinct()
    many = clean.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > wide).select(*keys)
    if many.isEmpty():
        return reach.narrow_closure(clean, keys)
    return reach.narrow_closure(clean.join(many, keys, "left_anti"), keys).unionByName(doubled(clean.join(many, keys, "left_semi"), keys))


def ancestors(edges: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Transitive (dependent, ancestor) pairs of known ids; a path may lead through ids that are gone. Nobody is their own ancestor."""
    ids = known.select(*keys, "id").distinct()
    pairs = closure(edges, keys, "dependent", "ancestor").where("a <> b").select(*keys, F.col("a").alias("dependent"), F.col("b").alias("ancestor"))
    return pairs.join(ids.withColumnRenamed("id", "dependent"), [*keys, "dependent"], "left_semi").join(ids.withColumnRenamed("id", "ancestor"), [*keys, "ancestor"], "left_semi")


def context_dependencies(edges: DataFrame, known: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(dependent, ancestor) pairs along sound edges alone, and the (dependent, target) ends of unsound ones, its own or its ancestors'.

    An edge is sound if both ids are known and the ancestor begins earlier (``start``).
    """
    at = lambda tag: known.select(*keys, F.col("id").alias(tag), F.col("start").alias(f"_{tag}"))
    both = edges.select(*keys, "dependent", "ancestor").distinct().join(at("dependent"), [*keys, "dependent"]).join(at("ancestor"), [*keys, "ancestor"], "left")
    sound = F.coalesce(F.col("_ancestor") < F.col("_dependent"), F.lit(False))
    good = closure(both.where(sound), keys, "dependent", "ancestor").select(*keys, F.col("a").alias("dependent"), F.col("b").alias("ancestor"))
    bad = both.where(~sound).select(*keys, "dependent", F.col("ancestor").alias("target"))
    inherited = good.join(bad.withColumnRenamed("dependent", "ancestor"), [*keys, "ancestor"]).select(*keys, "dependent", "target")
    return good, bad.unionByName(inherited).distinct()


def cycles(edges: DataFrame, keys: list[str], source: str = "before", target: str = "after") -> DataFrame:
    return closure(edges, keys, source, target).where("a = b").select(*keys, F.col("a").alias("id"))


def contradictions(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs that one relation has and the other has the other way round."""
    turned = second.select(*keys, F.col("after").alias("before"), F.col("before").alias("after"))
    return first.select(*keys, "before", "after").intersect(turned)


def narration_fill(pairs: DataFrame, claims: DataFrame, keys: list[str], least: int = 3) -> DataFrame:
    """(keys, before, after, source): stated order first, then the order of telling. Not coded in what this engine follows, only described there.

    Stated pairs are closed. A claim is displaced if more than half of its ``least`` or more stated pairs run against the telling; a pair that
    nothing states follows the telling (``position``), unless it touches a displaced claim.
    """
    stated = closure(pairs, keys, "before", "after").where("a <> b").select(*keys, F.col("a").alias("before"), F.col("b").alias("after"))
    at = lambda tag: claims.select(*keys, F.col("claim_id").alias(tag), F.col("position").alias(f"_{tag}"))
    told = stated.join(at("before"), [*keys, "before"]).join(at("after"), [*keys, "after"]).withColumn("_against", F.col("_before") > F.col("_after"))
    each = told.select(*keys, F.explode(F.array("before", "after")).alias("claim_id"), "_against")
    moved = each.groupBy(*keys, "claim_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("_against").alias("x")).where((F.col("n") >= least) & (2 * F.col("x") > F.col("n")))
    still = claims.where("position is not null").join(moved, [*keys, "claim_id"], "left_anti")
    side = lambda tag: still.select(*keys, F.col("claim_id").alias(tag), F.col("position").alias(f"_{tag}"))
    filled = side("before").join(side("after"), keys).where("_before < _after").select(*keys, "before", "after")
    turned = stated.select(*keys, F.col("after").alias("before"), F.col("before").alias("after"))
    free = filled.join(stated.unionByName(turned), [*keys, "before", "after"], "left_anti")
    return stated.withColumn("source", F.lit("stated")).unionByName(free.withColumn("source", F.lit("narration")))


def order_score(truth: DataFrame, predicted: DataFrame, keys: list[str]) -> DataFrame:
    """Of (keys, before, after) truth pairs: correct, wrong_direction or abstained, by the predicted pairs."""
    same = predicted.select(*keys, "before", "after").distinct().withColumn("_ok", F.lit(True))
    turned = predicted.select(*keys, F.col("after").alias("before"), F.col("before").alias("after")).distinct().withColumn("_no", F.lit(True))
    out = truth.join(same, [*keys, "before", "after"], "left").join(turned, [*keys, "before", "after"], "left")
    return out.withColumn("outcome", F.when(F.col("_ok"), "correct").when(F.col("_no"), "wrong_direction").otherwise("abstained")).drop("_ok", "_no")


def parent_violations(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, id, problem): parents that don't exist, don't contain their child, or form a cycle."""
    child = nodes.where("parent is not null")
    p = nodes.select(*keys, F.col("id").alias("parent"), F.col("start").alias("p0"), F.col("end").alias("p1"))
    joined = child.join(p, [*keys, "parent"], "left")
    missing = joined.where("p0 is null").select(*keys, "id", F.lit("missing parent").alias("problem"))
    outside = joined.where("start < p0 or end > p1").select(*keys, "id", F.lit("outside its parent").alias("problem"))
    loops = cycles(child.select(*keys, F.col("id").alias("before"), F.col("parent").alias("after")), keys).withColumn("problem", F.lit("cycle"))
    return missing.unionByName(outside).unionByName(loops)
