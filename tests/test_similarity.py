"""Similar token sets against all pairs."""

import random

import pytest

from folioscope.operators import similarity


def sets(seed, n, words=40):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.randint(1, 12)
        out.append((i, rng.sample([f"t{min(int(rng.expovariate(0.08)), words)}" for _ in range(60)], size) if rng.random() < 0.7 or not out else [*rng.choice(out)[1], f"t{rng.randint(0, words)}"]))
    return [*out, (900, []), (901, None), (902, [None, "t1"]), (None, ["t1", "t2"]), (903, ["t1", "t1"]), (904, ["everyone"])]


def plain(left, right, least):
    out = []
    for a, x in left:
        for b, y in right:
            x1, y1 = ({t for t in s or [] if t is not None} for s in (x, y))
            if x1 and y1 and len(x1 & y1) / len(x1 | y1) >= least:
                out.append((a, b, round(len(x1 & y1) / len(x1 | y1), 9)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("least", "block"), [(0.2, 20_000), (0.5, 3), (0.75, 20_000), (1.0, 20_000)])
def test_pairs_equal_all_pairs(spark, least, block):
    left, right = sets(1, 70), sets(2, 50)
    df = lambda rows, names: spark.createDataFrame([(*r, "x") for r in rows], f"{names[0]} int, {names[1]} array<string>, form string")
    got = similarity.jaccard_matches(df(left, ("a", "ta")), df(right, ("b", "tb")), least, block).collect()
    assert sorted(((r.a, r.b, round(r.similarity, 9)) for r in got), key=repr) == plain(left, right, least)
    assert similarity.jaccard_matches(df(left, ("a", "ta")).limit(0), df(right, ("b", "tb")), least).collect() == []


def test_minhash_finds_nearly_all(spark):
    left, right = sets(3, 120), sets(4, 120)
    df = lambda rows, names: spark.createDataFrame(rows, f"{names[0]} int, {names[1]} array<string>")
    got = {(r.a, r.b) for r in similarity.minhash_matches(df(left, ("a", "ta")), df(right, ("b", "tb")), 0.5).collect()}
    want = {x[:2] for x in plain(left, right, 0.5)}
    assert got <= want and len(got) >= 0.9 * len(want) > 60


def test_sets_are_put_in_order_without_a_shuffle(spark):
    forms = spark.createDataFrame([("f", 4, ["a", "b", "c", "d"])], "form string, n int, ts array<string>")
    got = similarity._prefixes(forms, spark.createDataFrame([("a", 9), ("c", 7)], "t string, df long"), 0.5)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r.t for r in got.collect()} == {"b", "d", "c"} and [r.t for r in got.orderBy("pos").collect()][2] == "c"
