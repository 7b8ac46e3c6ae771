"""How references are used: role mix, sole references, subjects named first, ambient nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import ROLES


def role_mix(refs: DataFrame) -> DataFrame:
    """Counts per role for each name, and for all as '*'; unassessed where there is no role. One pass, with ROLLUP."""
    counts = [F.count_if(F.col("role") == r).alias(r) for r in ROLES]
    out = refs.rollup("name").agg(*counts, F.count_if(F.col("role").isNull()).alias("unassessed"), F.count(F.lit(1)).alias("total"), F.grouping("name").alias("_all"))
    return out.withColumn("name", F.when(F.col("_all") == 1, "*").otherwise(F.col("name"))).drop("_all")


def sole_reference(refs: DataFrame, claim: str) -> DataFrame:
    """Of claims with exactly one reference: how many have a role, and how many a role other than subject. The rate is null if none has."""
    per = refs.groupBy(claim).agg(F.count(F.lit(1)).alias("n"), F.min("role").alias("role"))
    sole = F.col("n") == 1
    out = per.agg(F.count(F.lit(1)).alias("claims"), F.count_if(sole).alias("sole"), F.count_if(sole & F.col("role").isNotNull()).alias("assessed"), F.count_if(sole & F.col("role").isNotNull() & (F.col("role") != "subject")).alias("wrong"))
    return out.withColumn("wrong_rate", F.try_divide(F.col("wrong").cast("double"), F.col("assessed")))


def subject_first(claims: DataFrame, given: str | None = None) -> DataFrame:
    """Sole references whose head stands in the first 60 characters of the text: their name before a comma or bracket, or, as it is, the ``given`` field of the reference."""
    ref = F.element_at("refs", 1)
    head = F.trim(F.regexp_extract(ref["name"], "^([^,(]*)", 1)) if given is None else ref[given]
    sole = claims.where(F.size("refs") == 1).select(F.element_at("refs", 1)["role"].alias("role"), F.contains(T.lowered(F.substring("text", 1, 60)), T.lowered(head)).alias("first"))
    return sole.agg(F.count_if("first").alias("named_first"), F.count_if(F.col("first") & (F.col("role") == "subject")).alias("subject"), F.try_divide(F.count_if(F.col("first") & (F.col("role") == "subject")).cast("double"), F.count_if("first")).alias("rate"))


def ambient(refs: DataFrame, least_records: int = 5, most_rate: float = 0.25) -> DataFrame:
    """Names in many records that are the subject more often than background names should be."""
    out = refs.where(F.col("role").isNotNull()).groupBy("name").agg(F.count(F.lit(1)).alias("assessed"), F.countDistinct("record").alias("records"), (F.count_if(F.col("role") == "subject") / F.count(F.lit(1))).alias("subject_rate"))
    return out.where((F.col("records") >= least_records) & (F.col("subject_rate") > most_rate))


def report(claims: DataFrame, watched: DataFrame) -> DataFrame:
    """The four results as (check, key, value) rows. ``claims`` has digest_key, claim_id, text and refs; ``watched`` the ambient names."""
    refs = claims.select("digest_key", "claim_id", F.explode("refs").alias("r")).select("digest_key", "claim_id", "r.name", "r.role")
    line = lambda df, check, key, value: df.select(F.lit(check).alias("check"), key.cast("string").alias("key"), value.cast("double").alias("value"))
    named = refs.select("name", F.col("digest_key").alias("record"), "role").join(watched.select("name"), "name", "left_semi")
    return (
        line(sole_reference(refs, "claim_id"), "sole_reference", F.lit("wrong_rate"), F.col("wrong_rate"))
        .unionByName(line(subject_first(claims), "subject_first", F.lit("rate"), F.col("rate")))
        .unionByName(line(role_mix(refs), "role_mix", F.col("name"), F.col("total")))
        .unionByName(line(ambient(named), "ambient", F.col("name"), F.col("subject_rate")))
    )
