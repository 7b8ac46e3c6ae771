"""Sweeps against plain loops: one cell a key, and hot keys cut into cells."""

import random

import pytest

from folioscope.operators import grade, spans, sweep


def some_spans(seed, n, keys="ab", far=60):
    rng = random.Random(seed)
    out = [(rng.choice(keys), i, at := rng.randint(0, far), at + rng.choice([0, 1, 1, 2, 5, 9, 40])) for i in range(n)]
    return [*out, *[("a", n + i, 7, 30) for i in range(n // 3)], (None, 900, 1, 5), ("a", 901, None, 5), ("b", 902, 4, None)]


SHAPE = "k string, i int, start long, end long"
CUTS = [{}, {"cell_rows": 10, "cells": 6}, {"cell_rows": 3, "cells": 50}]


def held(rows):
    return [r for r in rows if None not in r and r[3] > r[2]]


@pytest.mark.parametrize("cut", CUTS)
def test_pairs_equal_a_plain_join(spark, cut):
    a, b = some_spans(1, 60), some_spans(2, 50, "abc")
    left = spark.createDataFrame(a, "k string, l int, l0 long, l1 long").withColumn("s", spans.F.lit("clash"))
    right = spark.createDataFrame(b, "k string, r int, r0 long, r1 long")
    got = sweep.overlap_pairs(left, right, ["k"], **cut)
    assert got.columns == ["k", "l", "l0", "l1", "s", "r", "r0", "r1"]
    want = sorted((x[0], x[1], y[1]) for x in held(a) for y in held(b) if x[0] == y[0] and max(x[2], y[2]) < min(x[3], y[3]))
    assert sorted((r.k, r.l, r.r) for r in got.collect()) == want
    assert sweep.overlap_pairs(left.limit(0), right, ["k"], **cut).collect() == []


@pytest.mark.parametrize("cut", CUTS)
def test_lengths_and_counts_equal_plain_loops(spark, cut):
    a, b = some_spans(3, 50), some_spans(4, 70)
    got = {(r.k, r.i): (r.length, r.touched) for r in sweep.both_ends(spark.createDataFrame(a, SHAPE), spark.createDataFrame(b, SHAPE), ["k"], ["i"], **cut).collect()}
    for k, i, s, e in a:
        if k is not None and s is not None and e is not None:
            shared = [min(e, y[3]) - max(s, y[2]) for y in held(b) if y[0] == k and max(s, y[2]) < min(e, y[3])] if e > s else []
            assert got[k, i] == (float(sum(shared)), len(shared))


@pytest.mark.parametrize("cut", CUTS)
def test_disjoint_parts_cover_the_union(spark, cut):
    a = some_spans(5, 40)
    got = sweep.disjoint(spark.createDataFrame(a, SHAPE), ["k"], **cut).collect()
    for k in "ab":
        points = [x for r in got if r.k == k for x in range(r.start, r.end)]
        assert len(points) == len(set(points)) and set(points) == {x for y in held(a) if y[0] == k for x in range(y[2], y[3])}


@pytest.mark.parametrize("cut", CUTS)
def test_reach_is_the_farthest_end_so_far(spark, cut):
    a = some_spans(6, 30)
    points = [(k, x) for k in "abz" for x in range(0, 100, 3)]
    got = {(r.k, r.x): r.reach for r in sweep.sums_upto(spark.createDataFrame(points, "k string, x long"), spark.createDataFrame(a, SHAPE), ["k"], "x", sweep.F.lit(True), **cut).collect()}
    assert got == {(k, x): max((float(y[3]) for y in held(a) if y[0] == k and y[2] <= x), default=None) for k, x in points}


def test_sums_without_keys(spark):
    a = [(x, x + 5) for x in range(0, 200, 2)]
    s = spark.createDataFrame(a, "start int, end int")
    for cut in CUTS:
        (row,) = sweep.both_ends(spark.createDataFrame([(1, 50, 100)], "i int, start int, end int"), s, [], ["i"], **cut).collect()
        assert (row.length, row.touched) == (float(sum(min(100, e) - max(50, b) for b, e in a if max(50, b) < min(100, e))), sum(max(50, b) < min(100, e) for b, e in a))


def test_unsupported_equals_plain_loops(spark):
    rng = random.Random(7)
    claims = [(rng.choice("rs"), f"c{i}", [(s := rng.randint(0, 50), s + rng.randint(0, 8)) for _ in range(rng.randint(0, 3))]) for i in range(60)]
    ranges = [(rng.choice("rst"), s := rng.randint(0, 40), s + rng.randint(1, 30), rng.random() < 0.7) for _ in range(12)]
    accepted = [(rng.choice("rs"), s := rng.randint(0, 60), s + rng.randint(0, 6)) for _ in range(20)]
    got = grade.unsupported(
        spark.createDataFrame(claims, "record_key string, claim_id string, spans array<struct<start:long,end:long>>"), spark.createDataFrame(ranges, "record_key string, start long, end long, complete boolean"), spark.createDataFrame(accepted, "record_key string, start long, end long")
    )
    want = {}
    for key in {r[0] for r in ranges if r[3]}:
        bounded = [c for c in claims if c[0] == key and c[2] and any(r[0] == key and r[3] and all(r[1] <= s and e <= r[2] for s, e in c[2]) for r in ranges)]
        lost = [c for c in bounded if not any(a[0] == key and max(s, a[1]) < min(e, a[2]) for s, e in c[2] for a in accepted)]
        want[key] = (len(bounded), len(lost))
    assert {r.record_key: (r.bounded, r.unsupported) for r in got.collect()} == want


def test_more_rows_make_more_tasks_of_running_sums(spark, monkeypatch):
    """A task of running sums holds no more rows as the table grows, and the sums stay the same."""
    claims = spark.range(2000).selectExpr("id % 50 AS record_key", "id AS claim_id", "id % 97 AS start", "id % 97 + 20 AS end")
    marks = spark.range(50).selectExpr("id AS record_key", "inline(array(named_struct('start', 10L, 'end', 50L), named_struct('start', 40L, 'end', 90L)))")
    out = lambda: sweep.both_ends(claims, marks, ["record_key"], ["claim_id"])
    few = out()
    rows = sorted(map(tuple, few.collect()))
    monkeypatch.setattr(sweep, "SUMMED", 100, raising=False)
    many = out()
    assert few.rdd.getNumPartitions() <= 4 and many.rdd.getNumPartitions() >= 4000 // 100
    assert len(rows) == 2000 and sorted(map(tuple, many.collect())) == rows
