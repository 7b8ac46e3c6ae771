"""Exact permutation tests: the splits of a pool by their sums, counted by dynamic programming over (size, scaled sum).

The table holds, for each number of values taken and each sum, how many choices give it, so 60 values cost a few thousand additions of rows and not
C(60, 30) sums. Values that are decimals of some digits become whole numbers and the count is exact. Others are counted by halves: the sums of all choices
from either half, sorted by size, meet in one search; beyond ``HALVES`` values, on the finest grid that the table holds, where sums nearer than a step for each
value are not told apart.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Decimals tried, numbers of the table, values counted by halves.
DIGITS, CELLS, HALVES = 9, 1 << 22, 32
_NEAR = 1e-9


def _scaled(pool: np.ndarray, n: int) -> np.ndarray | None:
    """The values from the least one on as whole numbers, at the fewest decimals that hold them; none if the table would be too wide."""
    away = pool - pool.min()
    for digits in range(DIGITS + 1):
        whole = np.round(away * 10.0**digits)
        if np.allclose(whole, away * 10.0**digits, rtol=0, atol=1e-6):
            whole = whole.astype(np.int64)
            step = int(np.gcd.reduce(whole)) or 1
            return whole // step if ((whole // step).sum() + 1) * (n + 1) <= CELLS else None
    return None


def _share_by_table(whole: np.ndarray, n: int, seen: int) -> float:
    """The share of choices of ``n`` values with a sum of ``seen`` or more; counts as doubles, so beyond 2^53 rounded in the last places."""
    ways = np.zeros((n + 1, int(whole.sum()) + 1))
    ways[0, 0] = 1
    for x in whole.tolist():
        ways[1:, x:] += ways[:-1, : ways.shape[1] - x].copy()
    return float(ways[n, max(seen, 0) :].sum() / ways[n].sum())


def _share_by_halves(pool: np.ndarray, n: int, least: float) -> float:
    """The same for any doubles: for each choice from the first half, how many of the second reach what is missing."""
    first, second = pool[: len(pool) // 2], pool[len(pool) // 2 :]
    sums = lambda xs, k: np.array([sum(c) for c in combinations(xs.tolist(), k)])
    hits = 0
    for k in range(max(0, n - len(second)), min(n, len(first)) + 1):
        other = np.sort(sums(second, n - k))
        hits += int((len(other) - np.searchsorted(other, least - sums(first, k), "left")).sum())
    return hits / comb(len(pool), n)


def permutation_p(a: list[float], b: list[float]) -> float:
    """One-sided exact p: the share of splits whose difference of means is at least the observed one."""
    pool, n = np.array([*a, *b], np.float64), len(a)
    # with fixed sizes the difference of means grows with the sum of the first arm
    whole = _scaled(pool, n)
    if whole is not None:
        return _share_by_table(whole, n, int(whole[:n].sum()))
    if len(pool) <= HALVES:
        return _share_by_halves(pool, n, float(pool[:n].sum()) - _NEAR * max(1.0, abs(float(pool.sum()))))
    step = (pool - pool.min()).sum() / (CELLS / (2 * (n + 1)))
    grid = np.round((pool - pool.min()) / step).astype(np.int64)
    return _share_by_table(grid, n, int(grid[:n].sum()))


def _p(arm: pa.Array, value: pa.Array) -> float:
    first = np.array(arm.to_pylist(), object) == "a"
    values = value.to_numpy(zero_copy_only=False)
    a, b = np.sort(values[first]), np.sort(values[~first])
    return permutation_p(a.tolist(), b.tolist()) if len(a) and len(b) else None


def permutation_test(rows: DataFrame, key: str) -> DataFrame:
    """(key, p) for (key, arm in a/b, value), as a grouped aggregate; a key with one arm alone has a null. Rows with a null arm or value don't count, nor do other arms.

    A key holds the runs of one comparison, some dozens of numbers.
    """
    good = rows.select(key, "arm", F.col("value").cast("double").alias("value"), F.coalesce(F.col("arm").isin("a", "b") & F.col("value").isNotNull(), F.lit(False)).alias("_good"))
    every = good.select(key).distinct()
    return every.join(good.where("_good").groupBy(key).agg(F.arrow_udf(_p, "double")("arm", "value").alias("p")), key, "left")
