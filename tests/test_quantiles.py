"""Radix selection and the permutation table against plain sorting and listing."""

import math
import random
import statistics
import time
from itertools import combinations

import numpy as np
import pytest

from folioscope.operators import permutation, quantiles


def test_codes_sort_as_numbers_do():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-300, 300, 500), [0.0, -0.0, np.inf, -np.inf, 5e-324, -5e-324]])
    assert (np.sort(x) == x[np.argsort(quantiles.sortable(x), kind="stable")]).all() and quantiles.sortable(np.array([0.0])) == quantiles.sortable(np.array([-0.0]))
    assert quantiles.sortable(np.array([np.nan]))[0] > quantiles.sortable(np.array([np.inf]))[0]


@pytest.mark.parametrize("few", [quantiles.FEW_RANKS, 0])
def test_medians_equal_sorting(spark, monkeypatch, few):
    """Ties, signs, nulls, null keys and one group of equal values; by broadcast ranks and by shuffled ones."""
    monkeypatch.setattr(quantiles, "FEW_RANKS", few)
    rng = random.Random(2)
    rows = [(rng.choice([*"abcd", None]), rng.choice([rng.gauss(0, 1e3), float(rng.randint(-3, 3)), 0.5, None])) for _ in range(400)] + [("same", 7.25)] * 300 + [("none", None)] * 3 + [("one", -1e300)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "k string, v double, n int").withColumnRenamed("n", "_left")
    got = {r.k: (r.m_x, r.n_x) for r in quantiles.medians(df, ["k"], "v", "x").collect()}
    want = {}
    for k in {r[0] for r in rows}:
        mine = [v for x, v in rows if x == k and v is not None]
        if mine:
            want[k] = (statistics.median(mine), len(mine))
    assert got == want
    (whole,) = quantiles.medians(df, [], "v", "all").collect()
    every = [v for _, v in rows if v is not None]
    assert (whole.m_all, whole.n_all) == (statistics.median(every), len(every))
    assert quantiles.medians(df.limit(0), [], "v", "all").collect() == quantiles.medians(df.limit(0), ["k"], "v", "all").collect() == []


def test_ranks_are_any(spark):
    df = spark.createDataFrame([(float(x),) for x in (5, 1, 1, 9)], "v double")
    F = quantiles.F
    (row,) = quantiles.ranked(df, [], "v", {"first": F.lit(1), "last": F.col("n"), "beyond": F.col("n") + 1, "upper": F.floor(F.col("n") / 2) + 1}).collect()
    assert (row.first, row.last, row.beyond, row.upper, row.n) == (1.0, 9.0, None, 5.0, 4) if not callable(row.first) else (row["first"], row.last, row.beyond, row.upper) == (1.0, 9.0, None, 5.0)


def listed(a, b):
    pool, total = a + b, sum(a + b)
    splits = [sum(c) for c in combinations(pool, len(a))]
    return sum(s >= sum(a) - 1e-9 * max(1.0, abs(total)) for s in splits) / len(splits)


def test_shares_equal_listing():
    rng = random.Random(3)
    for _ in range(60):
        draw = rng.choice([lambda: rng.randint(-9, 9), lambda: rng.randint(0, 99) / 8, lambda: rng.random(), lambda: rng.choice([1.5, 2.5]), lambda: rng.randint(1, 50) / 3])
        a, b = [float(draw()) for _ in range(rng.randint(1, 6))], [float(draw()) for _ in range(rng.randint(1, 6))]
        assert abs(permutation.permutation_p(a, b) - listed(a, b)) < 1e-12


def test_sixty_values_at_once():
    rng = random.Random(4)
    a, b = [rng.randint(0, 400) / 4 for _ in range(30)], [rng.randint(20, 420) / 4 for _ in range(30)]
    began = time.perf_counter()
    p = permutation.permutation_p(a, b)
    assert 0 < p < 1 and time.perf_counter() - began < 2
    # both sides of the observed sum and the sum itself make up all splits
    q = permutation.permutation_p(b, a)
    assert 1 <= p + q < 1.05
    odd = permutation.permutation_p([math.sqrt(x) for x in range(30)], [math.sqrt(x) + 0.5 for x in range(30)])
    assert 0.5 < odd < 1


def test_permutations_by_key(spark):
    rows = [("x", "a", 3.0), ("x", "a", 4.0), ("x", "b", 1.0), ("x", "b", 2.0), ("x", None, 9.0), ("x", "c", 9.0), ("x", "b", None), ("y", "a", 1.0), (None, "a", 1.0)]
    got = {r.k: r.p for r in permutation.permutation_test(spark.createDataFrame(rows, "k string, arm string, value double"), "k").collect()}
    assert got == {"x": 1 / 6, "y": None, None: None}
