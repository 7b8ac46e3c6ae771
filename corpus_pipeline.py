"""The corpus pipeline: quality rules, language ID, n-gram Jaccard join, benchmark decontamination, best-fit packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; the first four return the columns of ``documents``.

* quality rules: rejected documents go; of the others, the lines that fail a rule go, and ``n_chars`` follows the text.
* language ID: documents without a recognised language go; a missing ``lang`` is filled in.
* n-gram Jaccard join: of each class of near copies, one row with the smallest id stays.
* decontamination: documents that hold a benchmark window go.
* best-fit packing: the pieces of what is left, each with its sequence and offset.

A document is a row, judged by itself whatever its id, so ids may be null or repeat; a null id comes after the others. Null texts fail the quality rules; an empty table gives empty results of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import decontaminate as decontamination
from folioscope.llm import langid, ngram_join, packing, quality
from folioscope.llm.queries import WORD_BPE


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_clean(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_recognised(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from folioscope.llm.scratch import Scratch

    # the row goes along as one struct, so its columns may have any names
    rows = Scratch(spark, "rows").save(docs.select(F.monotonically_increasing_id().alias("number"), F.struct(*docs.columns).alias("row")), "rows")
    classes = ngram_join.jaccard_classes(rows.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text")))
    by_row = classes.select(F.col("doc_id").alias("number"), "component_id").join(rows.select("number", F.col("row.doc_id").alias("id")), "number")
    first = by_row.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "number")).alias("x"))
    return rows.join(first.select("x.number"), "number", "left_semi").select("row.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(docs, WORD_BPE)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Language ID is a fitted model, which SQL can't state; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioscope.llm.scratch import Scratch

    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.save(docs, f"{k}-{name}")
            scratch.keep(f"{k}-{name}")
    return docs
