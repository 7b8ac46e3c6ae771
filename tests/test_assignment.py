"""The auction against the textbook solver, in one task and dealt to blocks."""

import random
from itertools import permutations

import pytest
from plain_assignment import assignment as plain

from folioscope.operators import assignment


def test_the_plain_solver_is_optimal():
    rng = random.Random(3)
    for _ in range(60):
        n, m = rng.randint(1, 5), rng.randint(1, 5)
        w = [[rng.choice([0, 0, 1000 + rng.random()]) for _ in range(m)] for _ in range(n)]
        got = plain(w)
        assert len({j for j in got if j >= 0}) == sum(j >= 0 for j in got)
        size = max(n, m)
        best = max(sum(w[i][p[i]] for i in range(n) if p[i] < m) for p in permutations(range(size)))
        assert abs(sum(w[i][j] for i, j in enumerate(got) if j >= 0) - best) < 1e-6


def test_the_best_total_is_global(spark):
    c = spark.createDataFrame([("r", 1, 1, 0.9), ("r", 1, 2, 0.8), ("r", 2, 1, 0.7)], "g string, gold int, predicted int, score double")
    assert {(r.gold, r.predicted) for r in assignment.optimal_matches(c, "g").collect()} == {(1, 2), (2, 1)}


def candidates(seed, groups):
    """Random groups: ties, rows without candidates, unequal sides."""
    rng = random.Random(seed)
    for g in range(groups):
        n, m = rng.randint(1, 9), rng.randint(1, 9)
        for i in range(n):
            for j in range(m):
                if rng.random() < 0.5:
                    yield g, f"x{i}", 100 + j, rng.choice([0.25, 0.5, round(rng.random(), 6)])


@pytest.mark.parametrize("block_edges", [assignment.BLOCK_EDGES, 12])
def test_totals_equal_the_plain_solver(spark, block_edges):
    """Whole groups in one task; then blocks of some dozen edges, over rounds of bids."""
    rows = list(candidates(5, 12 if block_edges > 100 else 2))
    got = assignment.optimal_matches(spark.createDataFrame(rows, "g int, gold string, predicted long, score double"), "g", block_edges).collect()
    for g in {r[0] for r in rows}:
        mine, given = [r for r in got if r.g == g], {r[1:3]: r[3] for r in rows if r[0] == g}
        assert all(given[r.gold, r.predicted] == r.score for r in mine)
        assert len({r.gold for r in mine}) == len({r.predicted for r in mine}) == len(mine)
        golds, predicted = sorted({k[0] for k in given}), sorted({k[1] for k in given})
        w = [[1000 + given[x, y] if (x, y) in given else 0.0 for y in predicted] for x in golds]
        best = sum(w[i][j] for i, j in enumerate(plain(w)) if j >= 0)
        assert abs(sum(1000 + r.score for r in mine) - best) < 1e-6


def test_candidates_with_nulls_repeats_and_none(spark):
    shape = "g string, gold int, predicted int, score double, node string, price long"
    c = spark.createDataFrame([("a", 1, 2, 0.5, "n", 1), ("a", 1, 2, 0.7, "n", 1), ("a", None, 2, 0.9, "n", 1), ("a", 1, 2, None, "n", 1), (None, 1, 2, 0.9, "n", 1)], shape)
    assert [tuple(r) for r in assignment.optimal_matches(c, "g").collect()] == [("a", 1, 2, 0.7)]
    assert assignment.optimal_matches(c.limit(0), "g").collect() == []


def test_only_the_best_of_the_smaller_side_are_looked_at(spark):
    """Three nodes against sixty, either way round: at most three candidates of each, and the same total."""
    rng = random.Random(8)
    scores = [[rng.choice([0.5, rng.random()]) for _ in range(60)] for _ in range(3)]
    rows = [("a", i, j, s) for i, r in enumerate(scores) for j, s in enumerate(r)] + [("b", j, i, s) for i, r in enumerate(scores) for j, s in enumerate(r)] + [("a", 0, 0, 0.1)]
    c = spark.createDataFrame(rows, "g string, gold int, predicted int, score double")
    assert sorted(map(tuple, assignment._best(c, "g").groupBy("g").count().collect())) == [("a", 9), ("b", 9)]
    best = sum(scores[i][j] for i, j in enumerate(plain([[1000 + s for s in r] for r in scores])))
    got = assignment.optimal_matches(c, "g").collect()
    for g in "ab":
        assert abs(sum(r.score for r in got if r.g == g) - best) < 1e-5 and sum(r.g == g for r in got) == 3
