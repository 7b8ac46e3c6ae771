"""The stop rule of extraction as a stream: one row a round, and for each record the identities kept so far and where its chunks stand.

State is two lists a record: identities, and (chunk, rounds, stopped). It goes a while after a record's last round (``idle_ms``). A run that
is stopped takes up where its checkpoint ends, so rounds may come in any number of pieces, in order within a record.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.dedup import LEAST_NEW, MAX_ROUNDS

#: The provider that keyed map state needs.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROUND = "record_key string, chunk int, round long, items array<struct<pos:int,identity:string>>, complete boolean"
KEPT = "record_key string, chunk int, round long, pos int, identity string"


class StopRule(StatefulProcessor):
    """Keeps of each round the items that no earlier round kept, until its chunk says it is complete, brings too few, or has had all its rounds."""

    def __init__(self, least: int = LEAST_NEW, idle_ms: int | None = None):
        self.least, self.idle_ms = least, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", "identity string")
        self.chunks = handle.getListState("chunks", "chunk int, rounds int, stopped boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # each call of the state is a round trip to the JVM, so it is read once and written once
        seen = {x for (x,) in self.seen.get()}
        chunks = {chunk: (rounds, stopped) for chunk, rounds, stopped in self.chunks.get()}
        out, new = [], []
        given = pd.concat(list(rows)).sort_values(["chunk", "round"])
        for chunk, at, items, complete in zip(given["chunk"].tolist(), given["round"].tolist(), given["items"].tolist(), given["complete"].tolist(), strict=True):
            rounds, stopped = chunks.get(chunk, (0, False))
            if stopped:
                continue
            fresh = 0
            for x in sorted(([] if items is None else items), key=lambda x: x["pos"]):
                identity = x["identity"]
                if identity is not None and identity not in seen:
                    seen.add(identity)
                    new.append((identity,))
                    out.append((key[0], int(chunk), int(at), int(x["pos"]), identity))
                    fresh += 1
            chunks[chunk] = (rounds + 1, bool(complete) or fresh < self.least or rounds + 1 >= MAX_ROUNDS)
        if new:
            self.seen.appendList(new)
        self.chunks.put([(int(chunk), *x) for chunk, x in sorted(chunks.items())])
        if self.idle_ms:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in KEPT.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        self.chunks.clear()
        return iter(())

    def close(self) -> None:
        pass


def kept_items(rounds: DataFrame, least: int = LEAST_NEW, idle_ms: int | None = None) -> DataFrame:
    """The items that a stream of ``ROUND`` rows keeps, as ``KEPT`` rows. Items without an identity are none, and a round without items brings too few; rounds of a null record or chunk are left out."""
    spark = rounds.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    good = rounds.where("record_key is not null and chunk is not null and round is not null")
    return good.groupBy("record_key").transformWithStateInPandas(statefulProcessor=StopRule(least, idle_ms), outputStructType=KEPT, outputMode="Append", timeMode="ProcessingTime" if idle_ms else "None")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share."""
    import re
    import tempfile
    import uuid

    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="folioscope-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept_now(rounds: DataFrame, least: int = LEAST_NEW) -> DataFrame:
    """Everything there is now, run to the end and read back."""
    from .ingest import run_available

    base = shared_folder(rounds.sparkSession, "stop-rule")
    kept = kept_items(rounds, least)
    run_available(kept, f"{base}/kept", f"{base}/checkpoint")
    return rounds.sparkSession.read.schema(KEPT).parquet(f"{base}/kept")


def rounds_of(events: DataFrame) -> DataFrame:
    """Events as rounds: a user's days are chunks, and each event a round of three items."""
    second = F.expr("unix_micros(cast(ts as timestamp)) div 1000000")
    items = F.array(*[F.struct(F.lit(i).alias("pos"), c.alias("identity")) for i, c in enumerate((F.col("event_type"), F.concat(F.lit("v"), F.floor("value").cast("string")), F.concat(F.lit("k"), F.get_json_object("props", "$.k"))))])
    return events.select(F.col("user_id").cast("string").alias("record_key"), F.floor(second / (5 * 86400)).cast("int").alias("chunk"), F.col("event_id").cast("long").alias("round"), items.alias("items"), (F.col("value") > 60).alias("complete"))
