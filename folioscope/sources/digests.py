"""Digests: scanning, resolution to records, and the variant and canonical sinks."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
import yaml
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import ATTESTATIONS, CLAIM, CLAIM_TYPES, NODE

_LOADER = getattr(yaml, "CSafeLoader", yaml.SafeLoader)


def load(texts: DataFrame, key: str = "digest_key", text: str = "value") -> DataFrame:
    """(key, doc, issue): each file parsed once, to a variant that all readers take typed paths from; what can't be used is reported in ``issue`` and never dropped."""

    def one(t: str | None) -> tuple[str | None, str | None]:
        if t is None:
            return None, "unreadable"
        try:
            doc = yaml.load(t, _LOADER)
        except yaml.YAMLError:
            return None, "malformed_yaml"
        return (json.dumps(doc, default=str), None) if isinstance(doc, dict) else (None, "invalid_document")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            rows = [one(t) for t in df[text]]
            yield pd.DataFrame({key: df[key], "doc": [d for d, _ in rows], "issue": [i for _, i in rows]})

    parsed = texts.select(key, text).mapInPandas(run, f"{key} string, doc string, issue string")
    return parsed.select(key, F.try_parse_json("doc").alias("doc"), "issue")


def scan(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True).withColumn("digest_key", F.regexp_extract(F.input_file_name(), "([^/]+?)(?:\\.ya?ml)?$", 1))
    return load(files)


_CLAIM = "struct<id:string,type:string,attestation:string,speaker:struct<id:string,name:string>,provenance_chain:struct<origin_kind:string,origin:string,origin_ref:string,relay:array<string>>,attribution_in_text:boolean,location:string,location_in_record:string,date:string,date_range:array<string>,refs:array<struct<id:string,name:string,role:string>>,quote:string,original_excerpt:string,text:string,content:string,entailment:struct<label:string,score:double,model:string,premise:string>>"


def claims(digests: DataFrame) -> DataFrame:
    """Canonical claim rows. A ``claims`` list wins; otherwise domain then infrastructure claims, the category being the list."""
    d = digests.where("issue is null").select("digest_key", *[F.try_variant_get("doc", f"$.{c}", f"array<{_CLAIM}>").alias(c) for c in ("claims", "domain_claims", "infrastructure_claims")])
    tagged = lambda c, tag: F.transform(F.coalesce(F.col(c), F.array().cast(f"array<{_CLAIM}>")), lambda x: F.struct(F.lit(tag).alias("category"), x.alias("c")))
    both = F.when(F.col("claims").isNotNull(), tagged("claims", None)).otherwise(F.concat(tagged("domain_claims", "domain"), tagged("infrastructure_claims", "infrastructure")))
    known = lambda c, values, default: F.when(F.col(c).isin(*values), F.col(c)).otherwise(default)
    rows = d.select("digest_key", F.posexplode(both).alias("pos", "x")).select("digest_key", "pos", "x.category", "x.c.*")
    return rows.select(
        "digest_key", F.col("id").alias("claim_id"), F.col("category").cast("string").alias("category"), known("type", CLAIM_TYPES, "administrative").alias("type"), known("attestation", ATTESTATIONS, "first_hand").alias("attestation"),
        "speaker", "provenance_chain", "attribution_in_text", F.coalesce("location", "location_in_record").alias("location"), "date", "date_range", F.coalesce("refs", F.array().cast("array<struct<id:string,name:string,role:string>>")).alias("refs"),
        F.nullif(F.trim(F.coalesce("quote", "original_excerpt")), F.lit("")).alias("quote"), F.coalesce("text", "content").alias("text"), "entailment", F.struct(F.lit(0).alias("chunk"), F.lit(0).alias("round"), F.col("pos").alias("pos")).alias("ord"),
    ).to(spark_schema(digests.sparkSession, CLAIM))


def nodes(digests: DataFrame) -> DataFrame:
    """Node rows of known types only."""
    from ..schemas import NODE_TYPES

    d = digests.where("issue is null").select("digest_key", F.explode(F.try_variant_get("doc", "$.nodes", "array<struct<id:string,type:string,name:string,metadata:map<string,string>>>")).alias("n"))
    return d.where(F.col("n.type").isin(*NODE_TYPES)).select("digest_key", F.col("n.id").alias("node_id"), F.col("n.type").alias("node_type"), F.col("n.name").alias("name"), F.col("n.metadata").alias("metadata")).to(spark_schema(digests.sparkSession, NODE))


def usage(digests: DataFrame) -> DataFrame:
    """(digest_key, calls, reads, writes): cache tokens of a digest's newest ``ai_usage`` entry; nulls where it has none."""
    tokens = F.try_variant_get("doc", "$.ai_usage[0].tokens", "struct<calls:bigint,cache_read:bigint,cache_write:bigint>")
    return digests.where("issue is null").select("digest_key", tokens.alias("t")).select("digest_key", F.col("t.calls").alias("calls"), F.col("t.cache_read").alias("reads"), F.col("t.cache_write").alias("writes"))


def values_by_path(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, path, kind, n): of the fields of JSON texts, how many values of each kind there are; a text that is no JSON counts at the path ``$`` as ``malformed``."""
    doc = F.try_parse_json(text)
    kind = F.schema_of_variant("_v.value")
    bad = rows.where(F.col(text).isNotNull() & doc.isNull()).select(*keys, F.lit("$").alias("path"), F.lit("malformed").alias("kind"))
    fields = rows.select(*keys, doc.alias("_doc")).where("_doc is not null").lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("_doc").outer()).select(F.struct("pos", "key", "value").alias("_v")))
    found = fields.select(*keys, F.concat(F.lit("$."), F.col("_v.key")).alias("path"), kind.alias("kind"))
    return found.unionByName(bad).groupBy(*keys, "path", "kind").agg(F.count(F.lit(1)).alias("n"))


def spark_schema(spark: SparkSession, ddl: str):
    return spark.createDataFrame([], ddl).schema


def resolve(declared: DataFrame, stems: DataFrame, superseded: DataFrame) -> DataFrame:
    """hash -> record: a declared content hash wins over the file's stem, and that over what a record supersedes; within one, the first in order of record."""
    ranked = declared.withColumn("_p", F.lit(0)).unionByName(stems.withColumn("_p", F.lit(1))).unionByName(superseded.withColumn("_p", F.lit(2)))
    return ranked.groupBy("hash").agg(F.min_by("record", F.struct("_p", "record")).alias("record"))


def with_records(digests: DataFrame, records: DataFrame, on: str = "hash") -> DataFrame:
    """Left join that keeps digests without a record, as ``unknown``."""
    out = digests.join(records.withColumn("_found", F.lit(True)), on, "left")
    return out.withColumn("binding", F.when(F.col("_found"), "known").otherwise("unknown")).drop("_found")


def write_variants(rows: DataFrame, path: str) -> None:
    """All digests, each in the partition of its variant; a variant that is written again replaces itself alone."""
    parts = ["record", "model", "prompt_sha8", "run_label"]
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def production(rows: DataFrame) -> DataFrame:
    """The rows that may be canonical: no label, not variant-only, no override in any pass, and not of a trial model. One a record: the latest."""
    ok = (F.coalesce("run_label", F.lit("")) == "") & ~F.coalesce("variant_only", F.lit(False)) & ~F.coalesce("model", F.lit("")).startswith("opencode") & F.forall("passes", lambda p: p["version"] != "override") & (F.size("passes") > 0)
    best = Window.partitionBy("record").orderBy(F.desc("extracted_at"), "prompt_sha8")
    return rows.where(ok).withColumn("_r", F.row_number().over(best)).where("_r = 1").drop("_r").withColumn("run_kind", F.lit("production"))


def canonical_json(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def fingerprint(value) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


def upsert_configs(known: DataFrame, new: DataFrame) -> DataFrame:
    """Registry rows (fingerprint, config) with new ones added; one fingerprint with two configurations is an error."""
    both = known.unionByName(new).distinct()
    clash = both.groupBy("fingerprint").agg(F.countDistinct("config").alias("n")).where("n > 1")
    if not clash.isEmpty():
        raise ValueError("a fingerprint stands for two configurations")
    return both


def refresh_plan(current: DataFrame, records: DataFrame, fields: list[str], key: str = "record") -> DataFrame:
    """(key, field, old, new) of each header field that its record changed. Changes of speakers are refused: they are not the header's."""
    if "speakers" in fields:
        raise ValueError("speakers can't be refreshed")
    joined = current.select(key, *(F.col(f).cast("string").alias(f"o_{f}") for f in fields)).join(records.select(key, *(F.col(f).cast("string").alias(f"n_{f}") for f in fields)), key)
    rows = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"o_{f}").alias("old"), F.col(f"n_{f}").alias("new")) for f in fields))
    return joined.select(key, F.explode(F.filter(rows, lambda x: ~x["old"].eqNullSafe(x["new"]))).alias("x")).select(key, "x.*")


def refresh_apply(current: DataFrame, plan: DataFrame, fields: list[str], key: str = "record") -> DataFrame:
    """The headers with their planned changes."""
    wide = plan.groupBy(key).agg(*(F.max(F.when(F.col("field") == f, F.struct("new"))).alias(f"_{f}") for f in fields))
    out = current.join(wide, key, "left")
    for f in fields:
        out = out.withColumn(f, F.when(F.col(f"_{f}").isNotNull(), F.col(f"_{f}.new")).otherwise(F.col(f).cast("string")).cast(dict(current.dtypes)[f]))
    return out.select(*current.columns)


def memo(missing_key: list[str], wanted: DataFrame, stored: DataFrame, compute) -> DataFrame:
    """Stored results, and computed ones for keys that have none."""
    fresh = compute(wanted.join(stored.select(*missing_key), missing_key, "left_anti"))
    return stored.join(wanted.select(*missing_key).distinct(), missing_key, "left_semi").unionByName(fresh)
