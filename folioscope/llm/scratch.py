"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}

#: Rows of text per Arrow batch; a batch of whole documents must fit a Python worker.
ROWS_PER_BATCH = 500


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only where it is unset and all of Spark is one process, as in tests."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _LOCAL.setdefault("root", "file://" + tempfile.mkdtemp(prefix="folioscope-"))
    return root.rstrip("/")


class Scratch:
    """Parquet tables that cut lineage, so that a lost executor costs no long recomputation."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
        self.names: set[str] = set()
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)

    def save(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        """The table as written; where it is dealt to folders by some columns, a filter on those reads its own folders only."""
        path = f"{self.base}/{name}"
        df.write.mode("overwrite").partitionBy(*by).parquet(path)
        self.names.add(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Forget a table that nothing reads any more."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.names.discard(name)

    def keep(self, *names: str) -> None:
        """Forget all tables but these."""
        for name in self.names - set(names):
            self.drop(name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def narrow(df: DataFrame, key: str, text: str) -> DataFrame:
    """The two columns an operator reads, null text as empty, whatever other columns there are."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return df.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text))


def slices(batches, limit: int = 2 << 20):
    """The batches of (key, text), cut so that each holds about ``limit`` bytes of whole texts."""
    import numpy as np

    for batch in batches:
        column = batch.column(1)
        if not len(column):
            continue
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        at = 0
        while at < len(column):
            stop = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            stop = min(max(stop, at + 1), len(column))
            yield batch.slice(at, stop - at)
            at = stop
