"""The record store: which file is a record's body, its review, its timed words, its marked passages, and whether it is what it says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.validation import violations

_BODY = "^(?:(.*)/)?([0-9a-f]{64})((?:\\.v[0-9]+)?)\\.md$"
# Marked passages of a swept body, and how long one must be.
_MARKED, LEAST_PASSAGE = "(?s)\\{\\{highlight-start:?\\s*([A-Za-z0-9]*)[^}]*\\}\\}(.*?)\\{\\{highlight-end[^}]*\\}\\}", 40


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path relative to the root, size) of every file of a store; no content is read."""
    base = F.lit(root.rstrip("/") + "/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size"))
    return files.select(F.element_at(F.split("path", base), -1).alias("path"), "size")


def hashed(spark: SparkSession, path: str) -> DataFrame:
    """(name, sha256, value): the hash is of the same bytes that the text is read from; ``value`` is null where they are no UTF-8."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"), F.try_validate_utf8(F.col("content").cast("string")).alias("value"))


def bodies(files: DataFrame, raw: bool = False) -> DataFrame:
    """(hash, path[, size]): of a record's candidates in the store the first that is there.

    The newer version before the older; ``raw`` takes the other order's place for sizes of raw records, where files under ``v1`` count too, after all others.
    """
    get = lambda k: F.regexp_extract("path", _BODY, k)
    rows = files.where(F.col("path").rlike(_BODY)).select("*", get(1).alias("_dir"), get(2).alias("hash"), get(3).alias("_version"))
    known = rows.where(F.col("_version").isin("", ".v2") & F.col("_dir").isin("", "v1") if raw else F.col("_version").isin("", ".v2") & (F.col("_dir") == ""))
    order = F.struct(F.col("_dir"), (F.col("_version") != (".v2" if raw else "")).cast("int").alias("_v"))
    keep = F.struct("path", *([F.col("size")] if "size" in files.columns else []))
    return known.groupBy("hash").agg(F.min_by(keep, order).alias("_f")).select("hash", "_f.*")


def reviews(records: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Records with ``review``, the JSON text of their sidecar, beside the body or one folder above; null where there is none or it is no mapping.

    ``records`` has path; ``sidecars`` (path, value). The nearer one counts even if it is malformed.
    """
    folder = lambda c: F.regexp_extract(c, "^(?:(.*)/)?[^/]*$", 1)
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), "(\\.v[0-9]+)?\\.md$", ".review.json")
    r = records.withColumn("_name", name).withColumn("_dir", folder("path"))
    s = sidecars.where(F.col("path").endswith(".review.json")).select(F.element_at(F.split("path", "/"), -1).alias("_name"), folder("path").alias("_at"), F.col("value").alias("_value"))
    tried = r.select("path", "_name", F.explode(F.array(F.struct(F.lit(0).alias("n"), F.col("_dir").alias("_at")), F.struct(F.lit(1).alias("n"), folder("_dir").alias("_at")))).alias("t"), "_dir").where("t.n = 0 or _dir <> ''")
    found = tried.select("path", "_name", "t.n", "t._at").join(s, ["_name", "_at"]).groupBy("path").agg(F.min_by("_value", "n").alias("_value"))
    mapping = F.try_parse_json("_value").isNotNull() & F.trim("_value").startswith("{")
    return r.drop("_name", "_dir").join(found, "path", "left").withColumn("review", F.when(mapping, F.col("_value"))).drop("_value")


def sidecar_words(sidecars: DataFrame, key: str = "record_key", text: str = "value") -> DataFrame:
    """(key, pos, word, at) of word sidecars; a word without a time has its segment's, and else 0. One pass over each document, no shuffle."""
    shape = "segments array<struct<start:double,words:array<struct<w:string,start:double>>>>"
    words = lambda s: F.flatten(F.transform(F.coalesce(s["words"], F.array().cast("array<struct<w:string,start:double>>")), lambda w: _timed(w, s)))
    flat = F.flatten(F.transform(F.coalesce(F.from_json(text, shape)["segments"], F.array().cast("array<struct<start:double,words:array<struct<w:string,start:double>>>>")), words))
    return sidecars.select(key, F.posexplode(flat).alias("pos", "x")).select(key, "pos", "x.word", "x.at")


def _timed(word: Column, segment: Column) -> Column:
    at = F.coalesce(word["start"], segment["start"], F.lit(0.0))
    return F.transform(T.tokens(F.coalesce(word["w"], F.lit(""))), lambda t: F.struct(t.alias("word"), at.alias("at")))


def swept_passages(records: DataFrame, key: str = "record_key", body: str = "body") -> DataFrame:
    """(key, unit_id, text) of marked passages: start to next end, parts of one id joined in order, marks and comments gone, short ones left out."""
    found = F.regexp_extract_all(F.col(body), F.lit(_MARKED), F.lit(0))
    parts = records.select(key, F.posexplode(found).alias("n", "m")).select(key, "n", F.regexp_extract("m", _MARKED, 1).alias("id"), F.regexp_extract("m", _MARKED, 2).alias("part"))
    parts = parts.withColumn("unit_id", F.when(F.col("id") != "", F.col("id")).otherwise(F.concat(F.lit("_anon"), F.col("n").cast("string"))))
    whole = parts.groupBy(key, "unit_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "part"))), lambda x: x["part"]), " [...] ").alias("text"))
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace("text", "\\{\\{[^}]*\\}\\}", " "), "(?s)<!--.*?-->", " "), "(?U)\\s+", " "))
    return whole.withColumn("text", plain).where(F.length("text") > LEAST_PASSAGE)


def strict_violations(records: DataFrame, files: DataFrame) -> DataFrame:
    """(key, rule) rows of records that are not exactly what the store holds; none means strict.

    ``records`` has (name, value, sha256); ``files`` (path, sha256). A record begins and ends its front matter with an exact fence, declares a
    64-hex content hash, and has exactly one body in the store, byte for byte its own.
    """
    declared = F.regexp_extract("value", "(?m)^content_hash: *[\"']?(?:sha256:)?([0-9a-f]{64})[\"']? *$", 1)
    stored = files.where(F.col("path").rlike(_BODY)).groupBy(F.regexp_extract("path", _BODY, 2).alias("_hash")).agg(F.count(F.lit(1)).alias("_n"), F.collect_set("sha256").alias("_sums"))
    rows = records.withColumn("_hash", declared).join(stored, "_hash", "left")
    return violations(rows, "name", fence=F.col("value").rlike("(?s)\\A---\\n.*?\\n---\\n"), hash=F.col("_hash") != "", candidate=F.col("_n") == 1, bytes=F.array_contains("_sums", F.col("sha256")))
