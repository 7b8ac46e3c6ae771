"""Session defaults that the operators assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def session(app: str = "folioscope", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in (DEFAULTS | more).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
