"""Structured Streaming over new claims and events: our extension, as the batch operators have no stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def watch(spark: SparkSession, path: str, schema, files_per_batch: int = 64) -> DataFrame:
    """New Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def first_claims(claims: DataFrame, keys: list[str], at: str, late: str = "1 hour") -> DataFrame:
    """Each claim key once; state is dropped behind the watermark, so it is bounded by the lateness allowed."""
    return claims.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def windows(events: DataFrame, at: str, keys: list[str], width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(at, late).groupBy(F.window(at, width), *keys).agg(F.count(F.lit(1)).alias("n"))


def sessions(events: DataFrame, at: str, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(at, late).groupBy(F.session_window(at, gap), key).agg(F.count(F.lit(1)).alias("n"))


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Everything there is now, then stop: the incremental batch form of the stream."""
    stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path).awaitTermination()
