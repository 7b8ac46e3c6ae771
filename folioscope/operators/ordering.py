"""The orders that reports are listed in, their capped examples, and a reproducible sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_recall(rows: DataFrame, key: str) -> DataFrame:
    return rows.orderBy(F.desc_nulls_last("recall"), key)


def by_coverage(rows: DataFrame, key: str) -> DataFrame:
    """Best coverage, then best fidelity; none counts as 0."""
    return rows.orderBy(F.desc(F.coalesce("coverage", F.lit(0.0))), F.desc(F.coalesce("fidelity", F.lit(0.0))), key)


def by_cost(rows: DataFrame, key: str) -> DataFrame:
    return rows.orderBy(F.asc_nulls_last("cost"), key)


def by_size(rows: DataFrame, key: str) -> DataFrame:
    """The smallest first."""
    return rows.orderBy(F.asc_nulls_last("size"), key)


def shortened(c: Column, most: int) -> Column:
    return F.left(c, F.lit(most))


def examples(rows: DataFrame, keys: list[str], order: list[str], most: int) -> DataFrame:
    """The first rows of each key: a capped listing is the feature. Ranks are limited before the shuffle."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= most).drop("_n")


def sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows without replacement, the same for the same seed whatever the partitioning: those whose hashed key is smallest."""
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)


def length_sorted(rows: DataFrame, text: str, run, columns: str, size: int = 64) -> DataFrame:
    """``run`` over each batch's rows in groups of similar length, so that a model pads little; the rows come back in their own order.

    ``run`` takes and gives a pandas frame; ``columns`` is the schema it gives.
    """
    import pandas as pd

    def go(batches):
        for df in batches:
            df = df.reset_index(drop=True)
            order = df[text].fillna("").str.len().sort_values(kind="stable").index
            parts = [run(df.loc[order[i : i + size]]) for i in range(0, len(order), size)]
            if parts:
                yield pd.concat(parts).sort_index()

    return rows.mapInPandas(go, columns)
