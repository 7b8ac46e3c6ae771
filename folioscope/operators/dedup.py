"""Ordered first-wins deduplication and the replay of extraction rounds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_ROUNDS, LEAST_NEW = 40, 2


def claim_key(text: Column, kind: Column, attested: Column, speaker: Column, chain: Column | None = None) -> Column:
    """What makes two claims one: proposition, type, attestation, speaker, and an anonymous origin."""
    root = F.lit("") if chain is None else F.when(chain["origin_kind"] == "anonymous", F.coalesce(chain["origin_ref"], chain["origin"])).otherwise("")
    norm = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.struct(norm(text).alias("text"), F.coalesce(kind, F.lit("")).alias("type"), F.coalesce(attested, F.lit("")).alias("attestation"), norm(speaker).alias("speaker"), F.coalesce(root, F.lit("")).alias("root"))


def first_wins(rows: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each key in ``order``. An aggregate of whole rows (minimum by order), so equal keys shrink before the shuffle."""
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def first_value(rows: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """The first non-empty value of each key."""
    kept = rows.where(F.col(value).isNotNull() & (F.trim(value) != ""))
    return kept.groupBy(*keys).agg(F.min_by(value, F.struct(*order)).alias(value))


def numbered(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def replay_rounds(items: DataFrame, key: str = "record_key", least: int = LEAST_NEW) -> DataFrame:
    """What an extraction that stops by rule would have kept: (key, chunk, round, pos, identity, complete) rows.

    Within a chunk, rounds go on until one says it is complete, brings fewer than ``least`` new items, or is the 40th; items are new if no
    earlier round of any chunk kept them. Rounds after a stop never ran, so they suppress nothing. Sequential within a record.
    """

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        seen, keep = set(), []
        for _, chunk in rows.sort_values(["chunk", "round", "pos"]).groupby("chunk", sort=True):
            for n, (_, batch) in enumerate(chunk.groupby("round", sort=True)):
                fresh = ~batch["identity"].isin(seen) & ~batch["identity"].duplicated()
                keep.append(batch[fresh])
                seen.update(batch["identity"])
                if bool(batch["complete"].any()) or int((fresh & batch["identity"].notna()).sum()) < least or n + 1 >= MAX_ROUNDS:
                    break
        return pd.concat(keep) if keep else rows.iloc[:0]

    return items.groupBy(key).applyInPandas(fold, items.schema)
