"""Stream alignment against the plain table of longest common subsequences."""

import random
import time

import pytest

from folioscope.operators import accounts, sequences


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_subsequences_are_longest():
    rng = random.Random(1)
    for _ in range(300):
        letters = rng.choice(["ab", "abcd", "abcdefghijklmnop"])
        a, b = ([rng.choice(letters) for _ in range(rng.randint(0, 40))] for _ in range(2))
        got = sequences.common_subsequence(a, b)
        assert all(a[i] == b[j] for i, j in got) and all(x < y and u < v for (x, u), (y, v) in zip(got, got[1:], strict=False))
        assert len(got) == longest(a, b)


def test_chains_are_heaviest():
    rng = random.Random(2)
    for _ in range(80):
        segments = [(rng.randint(0, 30), rng.randint(0, 30), rng.randint(1, 5)) for _ in range(rng.randint(0, 9))]
        import numpy as np

        l, r, n = (np.array([s[k] for s in segments], np.int64) for k in range(3))  # noqa: E741
        got = sequences.chain(l, r, n)
        fits = lambda x, y: x[0] + x[2] <= y[0] and x[1] + x[2] <= y[1]
        assert all(fits(segments[i], segments[j]) for i, j in zip(got, got[1:], strict=False))
        best = {}
        for i, s in sorted(enumerate(segments), key=lambda x: x[1]):
            best[i] = s[2] + max((best[j] for j in best if fits(segments[j], s)), default=0)
        assert sum(segments[i][2] for i in got) == max(best.values(), default=0)


@pytest.mark.parametrize("gram", [3, 8])
def test_streams_align_as_the_plain_table(spark, gram):
    """Edits of all kinds in streams of rare words; whole streams of repeated words; moved blocks, empty and one-sided keys."""
    rng = random.Random(gram)
    texts = {}
    for k in range(6):
        a = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(30, 250))]
        b = [x for w in a for x in rng.choice([[w]] * 12 + [[], ["new"], [w, f"w{rng.randint(0, 400)}"]])]
        texts[f"k{k}"] = (a, b)
    texts["repeated"] = (["to"] * 60 + ["be"] * 10, ["to"] * 50 + ["or"] + ["be"] * 12)
    texts["few"] = (["a"], ["b", "a"])
    texts["apart"] = (["a", "b"], ["c"])
    texts["one"] = (["a"], [])
    rows = lambda side: [(k, i, w) for k, v in texts.items() for i, w in enumerate(v[side])] + [(None, 0, "x"), ("few", None, "x"), ("few", 9, None)]
    shape = "k string, pos int, word string"
    got = {}
    for x in sequences.matched_words(spark.createDataFrame(rows(0), shape), spark.createDataFrame(rows(1), shape), "k", gram).collect():
        got.setdefault(x.k, []).append((x.l, x.r))
    for k, (a, b) in texts.items():
        mine = sorted(got.get(k, []))
        assert all(a[i] == b[j] for i, j in mine) and all(x < y and u < v for (x, u), (y, v) in zip(mine, mine[1:], strict=False))
        assert len(mine) >= longest(a, b) - (len(a) // 50 if gram == 3 else 0), k
    assert len(got["repeated"]) == 60


def test_very_long_streams_take_little_memory():
    import tracemalloc

    rng = random.Random(3)
    a = [rng.randint(0, 50) for _ in range(20_000)]
    b = [x for x in a if rng.random() > 0.05]
    tracemalloc.start()
    began = time.perf_counter()
    assert len(sequences.common_subsequence(a, b)) == len(b)
    assert tracemalloc.get_traced_memory()[1] < 30e6 and time.perf_counter() - began < 60
    tracemalloc.stop()


def test_time_anchors_follow_the_words(spark):
    words = [("r", i, w, float(i)) for i, w in enumerate("we saw a um bright light over the the lake that night".split())]
    body = "We saw a bright light, over the lake -- that night!"
    got = spark.createDataFrame([("r", body), ("s", "none")], "record_key string, body string")
    (row,) = accounts.time_anchors(spark.createDataFrame(words, "record_key string, pos int, word string, at double"), got).collect()
    assert [(a.seconds, body[a.offset :].split()[0].strip(",!").lower()) for a in row.anchors if a.seconds in (0.0, 4.0, 11.0)] == [(0.0, "we"), (4.0, "bright"), (11.0, "night")]


def test_arrays_of_one_row_need_no_shuffle(spark, monkeypatch):
    """Rows with repeated and null keys and words, in pieces of few words; the plan has no exchange, and its places are those of the streams' rows."""
    rng = random.Random(4)
    texts = [[f"w{rng.randint(0, 90)}" for _ in range(rng.randint(0, 120))] for _ in range(40)]
    edit = lambda a: [x for w in a for x in rng.choice([[w]] * 9 + [[], ["new", w]])]
    moved = [f"x{i}" for i in range(40)]
    rows = [(i // 2 or None, i, a, edit(a)) for i, a in enumerate(texts)] + [(7, 90, ["a", None, "b", "c"], ["z", "b", None, "c"]), (7, 91, None, ["a"]), (7, 92, moved, moved[25:] + moved[:25])]
    df = spark.createDataFrame(rows, "k int, n int, a array<string>, b array<string>")
    monkeypatch.setattr(sequences, "WORDS", 300)
    got = sequences.aligned(df, "a", "b", 4)
    assert got.columns == ["k", "n", "places"] and "Exchange" not in got._jdf.queryExecution().sparkPlan().toString()
    found = {r.n: (r.k, [tuple(x) for x in r.places]) for r in got.collect()}
    assert len(found) == len(rows)
    for k, n, a, b in rows:
        mine = found[n][1]
        assert found[n][0] == k and all(a[i] == b[j] for i, j in mine) and all(x < y and u < v for (x, u), (y, v) in zip(mine, mine[1:], strict=False))
        assert len(mine) >= longest(a or [], b or []) - (3 if n < 90 else 0)
    assert found[90][1] == [(2, 1), (3, 3)] and found[91][1] == [] and found[92][1] == [(i, i + 15) for i in range(25)]


def test_long_streams_go_by_joins(spark):
    """Streams beyond the limit and others give the same places together."""
    rng = random.Random(5)
    left = {k: [f"w{rng.randint(0, 300)}" for _ in range(60 * (k + 1))] for k in range(3)}
    rows = lambda side: [(k, 3 * i, w) for k, v in left.items() for i, w in enumerate(v) if side or i % 13]
    a, b = (spark.createDataFrame(rows(side), "k int, pos int, word string") for side in (0, 1))
    whole, parted = (sorted(map(tuple, sequences.matched_words(a, b, "k", 4, n).collect())) for n in (sequences.LONG, 100))
    assert len(whole) == len(parted) == len(rows(0)) and {x[0] for x in parted} == {0, 1, 2}
    word = {(k, p): w for k, p, w in rows(1)}
    assert all(word[k, x] == word[k, y] for got in (whole, parted) for k, x, y in got)
