"""Neighbours against all rows."""

import numpy as np

from folioscope.operators import neighbours
from folioscope.session import table


def test_neighbours_of_every_twentieth(spark):
    """Recall of the index against the exact way, over the given vectors, whole."""
    v = table(spark, "/root/testdata/sf0.1", "embeddings")
    q = v.where("vec_id % 20 = 0")
    found = {(r.query, r.neighbour) for r in neighbours.neighbours(v, q, "vec_id", "embedding", 64).collect()}
    true = {(r.query, r.neighbour) for r in neighbours.exact_neighbours(v, q, "vec_id", "embedding", 64).collect()}
    assert len(true) == 10 * q.count() and len(found & true) >= 0.9 * len(true)


def test_exact_neighbours_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERIES", 7)
    rng = np.random.default_rng(2)
    x = rng.integers(0, 4, (120, 5)).astype(float)  # many ties
    rows = [(i, v.tolist(), "c") for i, v in enumerate(x)] + [(500, None, "c"), (501, [1.0], "c"), (502, [float("nan")] * 5, "c"), (None, [1.0] * 5, "c")]
    v = spark.createDataFrame(rows, "i long, x array<double>, query string").repartition(3)
    q = v.where("i % 20 = 0")
    want = {}
    for a in range(0, 120, 20):
        d = ((x - x[a]) ** 2).sum(1)
        want[a] = [b for _, b in sorted((d[b], b) for b in range(120) if b != a)][:4]
    for got in (neighbours.exact_neighbours(v, q, "i", "x", 5, 4).collect(), neighbours.neighbours(v, q, "i", "x", 5, 4, block=16).collect()):
        by = {}
        for r in sorted(got, key=lambda r: (r.query, r.rank)):
            by.setdefault(r.query, []).append(r.neighbour)
        hits = sum(len(set(by[a]) & set(want[a])) for a in want)
        assert set(by) == set(want) and hits >= 0.9 * sum(map(len, want.values()))
    assert {r.query: r.neighbour for r in got if r.rank == 1}.keys() == want.keys()
    assert neighbours.neighbours(v.limit(0), q, "i", "x", 5).collect() == []
