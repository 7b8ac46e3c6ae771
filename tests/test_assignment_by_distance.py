"""Assignments by distance against the textbook solver, and at the size of many pairs."""

import random
import time

import numpy as np
import pytest
from plain_assignment import assignment as plain

from folioscope.operators import assignment


def score(x):
    return 1 / (1 + x / 1000)


@pytest.mark.parametrize("spread", [300, 6000, 60_000])
def test_totals_equal_the_plain_solver(spread):
    """Crowded, plain and lonely values; ties, and nodes of many values."""
    rng = random.Random(spread)
    for _ in range(120):
        n = rng.randint(1, 12)
        m = rng.randint(n, 16)
        value = lambda: float(rng.choice([rng.randint(0, 5) * 100, rng.randint(0, spread)]))
        few, many = ([[value() for _ in range(rng.choice([1, 1, 1, 2]))] for _ in range(k)] for k in (n, m))
        slots = sorted((x, j) for j, xs in enumerate(many) for x in xs)
        got = assignment.nearest_assignment([np.array(x) for x in few], np.array([x for x, _ in slots]), np.array([j for _, j in slots]), score, 0.28)
        best = [[max(score(abs(x - y)) for x in a for y in b) for b in many] for a in few]
        w = [[1000 + s if s >= 0.28 else 0.0 for s in r] for r in best]
        taken = [j for j in got if j >= 0]
        assert len(set(taken)) == len(taken) and all(best[i][j] >= 0.28 for i, j in enumerate(got) if j >= 0)
        total = lambda found: sum(w[i][j] for i, j in enumerate(found) if j >= 0)
        assert abs(total(got) - total(plain(w))) < 1e-4


def test_groups_of_many_pairs_are_settled_without_them():
    """86 million pairs."""
    rng = np.random.default_rng(1)
    few, many = rng.uniform(-1000, 10_000, 2400).round(2), np.sort(rng.uniform(-1000, 10_000, 36_000).round(2))
    began = time.perf_counter()
    got = assignment.nearest_assignment([np.array([x]) for x in few], many, np.arange(36_000), score, 0.28)
    assert len(set(got.tolist())) == 2400 and got.min() >= 0 and time.perf_counter() - began < 30


def test_odd_rows_and_either_side_smaller(spark):
    shape = "g string, {} int, at double"
    gold = spark.createDataFrame([("a", 1, 0.0), ("a", 1, 0.0), ("a", 2, 900.0), ("a", None, 5.0), ("a", 3, None), ("b", 1, 10.0), (None, 1, 0.0), ("c", 1, 0.0), ("d", 1, float("nan")), ("d", 2, float("inf"))], shape.format("gold"))
    predicted = spark.createDataFrame([("a", 7, 100.0), ("b", 8, 60.0), ("b", 9, 20.0), (None, 1, 0.0), ("e", 1, 0.0), ("c", 5, 1e6), ("d", 1, 0.0)], shape.format("predicted"))
    got = assignment.matches_by_distance(gold, predicted, "g", lambda x: 1 / (1 + x / 1000), 0.28)
    assert sorted(map(tuple, got.collect())) == [("a", 1, 7, score(100.0)), ("b", 1, 9, score(10.0))]
