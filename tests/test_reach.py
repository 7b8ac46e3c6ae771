"""Paths by bit vectors against plain search."""

import random

import numpy as np
import pytest

from folioscope.operators import graph, reach


def searched(edges):
    after = {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)
    out = set()
    for a in after:
        todo, seen = list(after[a]), set()
        while todo:
            b = todo.pop()
            if b not in seen:
                seen.add(b)
                todo += after.get(b, ())
        out |= {(a, b) for b in seen}
    return out


def test_bits_equal_search():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 12)
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randint(0, 20))]
        got = reach.reachable(n, np.array(edges, np.int64).reshape(-1, 2))
        assert {(a, b) for a, bits in enumerate(got) for b in range(n) if bits >> b & 1} == searched(edges)


def test_long_chains_need_no_recursion():
    n = 20_000
    got = reach.reachable(n, np.array([(i, i + 1) for i in range(n - 1)]))
    assert got[0].bit_count() == n - 1 and got[-1] == 0


@pytest.mark.parametrize("wide", [reach.WIDE, 8])
def test_closures_equal_search(spark, wide):
    rng = random.Random(2)
    edges = [(k, rng.randint(0, 9), rng.randint(0, 9)) for k in "abcdef" for _ in range(rng.randint(1, 14))] + [("a", 1, 1), ("a", None, 2), (None, 1, 2)]
    got = graph.closure(spark.createDataFrame(edges, "k string, x int, y int"), ["k"], "x", "y", wide).collect()
    want = {(k, *p) for k in "abcdef" for p in searched([(x, y) for q, x, y in edges if q == k and x is not None])}
    assert {(r.k, r.a, r.b) for r in got} == want and len(got) == len(want)
