"""The extractor seam: rounds of items from a pluggable source, replayed by rule. The default answers from a canned table; nothing calls a model."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import replay_rounds


class Extractor(Protocol):
    """Gives (record_key, chunk, round, pos, identity, complete, item) rows for (record_key, idx, text) chunks."""

    def rounds(self, chunks: DataFrame) -> DataFrame: ...


class Canned:
    """Answers from a table of recorded rounds."""

    def __init__(self, responses: DataFrame):
        self.responses = responses

    def rounds(self, chunks: DataFrame) -> DataFrame:
        asked = chunks.select("record_key", F.col("idx").alias("chunk")).distinct()
        return self.responses.join(asked, ["record_key", "chunk"], "left_semi")


def run(chunks: DataFrame, extractor: Extractor) -> DataFrame:
    """The items that the stop rule keeps, first wins across chunks and rounds."""
    return replay_rounds(extractor.rounds(chunks))
