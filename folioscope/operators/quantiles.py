"""Exact order statistics of groups by radix selection: counts for each prefix of the values' bits, never the values themselves in one task.

A double's bits, with the sign turned about, sort as the number does. Three rounds fix 22, 21 and 21 bits of a wanted rank: each counts the
values under each prefix and finds the one that holds the rank. Equal values are counted once, before anything else.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import saved

#: Bits that each round fixes, and ranks up to which their table goes to all tasks.
ROUNDS, FEW_RANKS = (22, 21, 21), 100_000
_TURN = np.int64(0x7FFF_FFFF_FFFF_FFFF)


def sortable(values: np.ndarray) -> np.ndarray:
    """Longs that sort as the doubles do; -0 is 0, and NaN comes last."""
    values = np.where(np.isnan(values), np.nan, values + 0.0)
    bits = values.view(np.int64)
    return np.where(bits < 0, bits ^ _TURN, bits)


def _code(values: pd.Series) -> pd.Series:
    return pd.Series(sortable(values.to_numpy(np.float64)))


def _value(codes: pd.Series) -> pd.Series:
    bits = codes.to_numpy(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ _TURN, bits).view(np.float64))


def ranked(rows: DataFrame, keys: list[str], value: str, ranks: dict[str, Column]) -> DataFrame:
    """(keys, n, one column for each rank): the values at 1-based ranks, each a column expression in ``n``, the number of values of the group.

    Nulls are no values; a group without values has no row, and a rank outside 1 to n gives null. Null keys are a group of their own.
    """
    equal = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    counts = saved(equal.withColumn("_v", F.pandas_udf(_code, "long")("_v")))
    sizes = saved(counts.groupBy(*keys).agg(F.sum("_c").alias("n")))
    asked = sizes.select(*keys, "n", F.posexplode(F.array(*[r.cast("long") for r in ranks.values()])).alias("_rank", "_left"))
    picks = asked.where("_left between 1 and n").withColumn("_prefix", F.lit(0).cast("long"))
    few = sizes.count() * len(ranks) <= FEW_RANKS
    same = lambda a, b: [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    done = 0
    for bits in ROUNDS:
        rest = 64 - done - bits
        # prefixes of what is fixed so far; the first round has none
        b = picks.alias("b")
        on = [*same("a", "b"), F.shiftright(F.col("a._v"), 64 - done) == F.col("b._prefix")] if done else same("a", "b")
        joined = counts.alias("a").join(F.broadcast(b) if few else b, on) if on else counts.alias("a").crossJoin(F.broadcast(b))  # a handful of ranks
        step = joined.groupBy(*[F.col(f"b.{k}").alias(k) for k in keys], F.col("b._rank").alias("_rank"), F.col("b._left").alias("_left"), F.shiftright(F.col("a._v"), rest).alias("_prefix")).agg(F.sum("a._c").alias("_c"))
        w = Window.partitionBy(*keys, "_rank").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
        upto = step.withColumn("_upto", F.sum("_c").over(w))
        picks = upto.where("_upto >= _left and _upto - _c < _left").select(*keys, "_rank", (F.col("_left") - F.col("_upto") + F.col("_c")).alias("_left"), "_prefix")
        done += bits
    found = picks.withColumn("_x", F.pandas_udf(_value, "double")("_prefix"))
    wide = found.groupBy(*keys).agg(*[F.max(F.when(F.col("_rank") == i, F.col("_x"))).alias(name) for i, name in enumerate(ranks)])
    if not keys:
        return sizes.where("n is not null").crossJoin(F.broadcast(wide))  # one row
    return sizes.alias("a").join(wide.alias("b"), same("a", "b"), "left").select("a.*", *ranks)


def medians(rows: DataFrame, keys: list[str], value: str, tag: str) -> DataFrame:
    """The exact median and number of each group, as m_ and n_; the mean of the middle two where the number is even."""
    n = F.col("n")
    out = ranked(rows, keys, value, {"_low": F.floor((n + 1) / 2), "_high": F.floor((n + 2) / 2)})
    return out.select(*keys, ((F.col("_low") + F.col("_high")) / 2).alias(f"m_{tag}"), F.col("n").alias(f"n_{tag}"))
