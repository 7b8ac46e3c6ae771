"""Joins beyond plain equality: nearest in time, aliases, loose token overlap, expansion, violations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def nearest_forward(points: DataFrame, anchors: DataFrame, keys: list[str], at: str, anchor_at: str, value: str) -> DataFrame:
    """The first anchor at or after each point, else the last one: one sort over the union of both sides, no pairs."""
    p = points.withColumn("_t", F.col(at)).withColumn("_v", F.lit(None).cast(dict(anchors.dtypes)[value])).withColumn("_is", F.lit(0))
    a = anchors.select(*keys, F.col(anchor_at).alias("_t"), F.col(value).alias("_v"), F.lit(1).alias("_is"))
    both = p.unionByName(a, allowMissingColumns=True)
    ahead = Window.partitionBy(*keys).orderBy("_t", "_is", "_v").rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*keys)
    near = F.first(F.when(F.col("_is") == 1, F.col("_v")), ignorenulls=True).over(ahead)
    last = F.max_by("_v", F.when(F.col("_is") == 1, F.struct("_t", "_v"))).over(whole)
    out = both.withColumn(value, F.coalesce(near, last)).where("_is = 0")
    return out.select(*points.columns, value)


def alias_matches(extracted: DataFrame, golden: DataFrame) -> DataFrame:
    """Names that share a normal form: (ext_id, name) against (golden_id, name); the first golden row wins."""
    e = extracted.select("ext_id", F.explode(T.name_variants(F.col("name"))).alias("form"))
    g = golden.select("golden_id", F.explode(T.name_variants(F.col("name"))).alias("form")).groupBy("form").agg(F.min("golden_id").alias("golden_id"))
    return e.join(g, "form").groupBy("ext_id").agg(F.min("golden_id").alias("golden_id"))


def loose_matches(extracted: DataFrame, golden: DataFrame, least_shared: int = 2, least_coverage: float = 0.6) -> DataFrame:
    """Names that share two content tokens or more and 0.6 of a golden form's; best coverage, then the earliest.

    Equal token sets meet once. A match has at least ``need`` of a golden form's n tokens, so one of its n - need + 1 rarest: they alone are
    the join's keys, and tokens that a great many names share are keys only of forms that have no others.
    """
    e = extracted.select("ext_id", T.loose_tokens(F.col("name")).alias("ts")).withColumn("ts", F.array_sort("ts"))
    g = golden.select("golden_id", T.loose_tokens(F.col("name")).alias("ts")).withColumn("gs", F.array_sort("ts")).groupBy("gs").agg(F.min("golden_id").alias("golden_id"))
    g = g.withColumn("n", F.size("gs")).withColumn("need", F.greatest(F.lit(least_shared), F.ceil(F.lit(least_coverage) * F.col("n") - 1e-9))).where("n >= need")
    forms = e.select("ts").distinct()
    df = forms.select(F.explode("ts").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    ranked = g.select("gs", "golden_id", "n", "need", F.explode("gs").alias("t")).join(df, "t", "left")
    rare = ranked.groupBy("gs", "golden_id", "n", "need").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "t"))).alias("xs"))
    keys = rare.select("gs", "golden_id", "n", "need", F.explode(F.slice("xs", F.lit(1), (F.col("n") - F.col("need") + 1).cast("int"))).alias("x")).where("x.df > 0").select("gs", "golden_id", "n", "need", F.col("x.t").alias("t"))
    pairs = forms.select("ts", F.explode("ts").alias("t")).join(keys, "t").select("ts", "gs", "golden_id", "n", "need").distinct()
    kept = pairs.withColumn("common", F.size(F.array_intersect("ts", "gs")).cast("long")).where("common >= need")
    best = kept.groupBy("ts").agg(F.min_by(F.struct("golden_id", "common", "n"), F.struct((-F.col("common") / F.col("n")).alias("c"), "golden_id")).alias("m"))
    return e.join(best, "ts").select("ext_id", F.col("m.golden_id").alias("golden_id"), F.col("m.common").alias("common"), F.col("m.n").alias("n"))


def expand_sources(claims: DataFrame, sources: DataFrame, key: str = "source_id") -> DataFrame:
    """A claim's source id becomes its chain; unmatched claims stay, with ``resolved`` false."""
    s = sources.withColumn("resolved", F.lit(True))
    return claims.join(s, key, "left").withColumn("resolved", F.coalesce("resolved", F.lit(False)))


def violations(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key).distinct(), key, "left_anti")
