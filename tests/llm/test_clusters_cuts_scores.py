"""Centroid clustering, cross-tokenizer alignment and the additive quality model against brute force, SQL and held-out labels."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from folioscope.llm import centroids, cross_tokens, gam, queries
from oracle import rows_of, same

CLASH = "doc_id long, text string, row long, codes string, many int, x double, score string"


def clustered(seed, n, dims=64):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(6, dims))[rng.integers(0, 6, n)] + 0.1 * rng.normal(size=(n, dims))).astype(np.float32)


# --- centroid clustering


def test_clusters_equal_sql(spark, small):
    same(queries.op11_centroid_clustering(spark, small), queries.ORACLES["op11_centroid_clustering"], small)


def test_clusters_of_odd_vectors(spark, tmp_path):
    """Nulls, wrong lengths, copies, ties and other columns; a third of all rows is one vector."""
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(clustered(1, 1500))]
    rows += [(2000 + i, rows[7][1], 2) for i in range(800)] + [(10_000, None, 1), (10_001, [1.0] * 63, 1), (10_002, [float("nan")] + [0.0] * 63, 1), (10_003, [None] + [0.0] * 63, 1), (10_004, [float("inf")] + [0.0] * 63, 1), (5, rows[5][1], 9)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int").repartition(3)
    (tmp_path / "x").mkdir()
    pq.write_table(pa.table({"vec_id": [r[0] for r in rows], "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32()))}), tmp_path / "x" / "embeddings.parquet")
    got = centroids.lloyd(vectors)
    assert got.count() == 1500 + 800 + 1
    same(got, centroids.oracle(), str(tmp_path / "x"))


def test_trees_prune_and_stay_exact():
    q = centroids.whole_numbers(clustered(2, 1000, 8))
    order, nodes = centroids.cover_tree(q)
    assert sorted(order) == list(range(1000))
    for x in nodes:
        inside = np.sqrt(((q[order[x["first"] : x["last"]]] - q[order[x["pivot"]]]) ** 2).sum(1))
        assert inside.max() <= x["radius"] + 1e-6
    m = q[:40]
    tree = centroids._tree_of(m.tolist())
    cluster, opened = np.full(1000, -1), 0
    for first, last, c in centroids.nearest(q[order], nodes, m, tree):
        opened += int((last - first == 1).sum())
        cluster[centroids._ranges(first, last)] = np.repeat(c, last - first)
    assert (cluster == ((q[order][:, None] - m[None]) ** 2).sum(2).argmin(1)).all()
    same_points = np.repeat(q[:1], 500, axis=0)
    assert len(centroids.cover_tree(same_points)[1]) == 1


def test_clusters_of_extremes(spark):
    shape = "vec_id long, embedding array<double>"
    assert centroids.lloyd(spark.createDataFrame([], shape)).collect() == []
    few = centroids.lloyd(spark.createDataFrame([(1, [0.5] * 64), (None, [9.0] * 64)], shape)).collect()
    assert {(r.vec_id, r.cluster, r.distance) for r in few} == {(1, 0, 0), (None, 1, 0)}
    far = [(i, [1e300 * (-1) ** i] + [0.0] * 63) for i in range(12)] + [(20, [1e5] * 64), (21, [1e5 + 1] * 64)]
    out = {r.vec_id: r for r in centroids.lloyd(spark.createDataFrame(far, shape)).collect()}
    assert len(out) == 14 and all(r.distance >= 0 and r.inertia <= centroids.LONG for r in out.values())
    assert all(hashlib.sha256(b"x").hexdigest() != r.centroid_sha256 and len(r.centroid_sha256) == 64 for r in out.values())


# --- cross-tokenizer alignment

ODD = ["", " ", "a  b", "\n", "x\n\ny", " lead", "trail ", "tab\there", "a \tb", "nbsp x y", "emoji 😀 👩‍👩‍👧", "▁under score", "<|endoftext|> x", "<0x0A> y", "</s> z <unk>", "y" * 3000, "a\x00b c", "ﬁ ligature", "é x ́y", "\x1c a", "a\r\nb", "don't  we'll", "a　b c", "​ z", "1234 567, 89.0"]


def plain_alignment(text):
    """(a, b, groups, links) by sets of offsets over the whole text, or None."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    tools = plain_alignment.__dict__
    if "a" not in tools:
        tools["a"] = Tokenizer.from_file(P.path(queries.BYTE_BPE))
        tools["a"].encode_special_tokens = True
        tools["b"] = sentencepiece.SentencePieceProcessor(model_file=P.path(queries.PIECES))
        byte_of = {}
        for token, i in tools["a"].get_vocab().items():
            byte_of[i] = token
        keys = [*range(33, 127), *range(161, 173), *range(174, 256)]
        chars = {chr(b): b for b in keys} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in keys)}
        tools["bytes_a"] = lambda i: bytes(chars[c] for c in byte_of[i])
    a, b = tools["a"].encode(" " + text, add_special_tokens=False).ids, tools["b"].encode(text)
    bytes_b = lambda i: bytes([int(tools["b"].id_to_piece(i)[3:5], 16)]) if tools["b"].is_byte(i) else tools["b"].id_to_piece(i).replace("▁", " ").encode()
    xs, ys = [tools["bytes_a"](i) for i in a], [bytes_b(i) for i in b]
    if not text or b"".join(xs) != b"".join(ys) or b"".join(xs) != (" " + text).encode():
        return None
    ea, eb = list(itertools.accumulate(map(len, xs))), list(itertools.accumulate(map(len, ys)))
    groups, i, j = [], 0, 0
    for e in sorted(set(ea) & set(eb)):
        p, q = ea.index(e, i) + 1, eb.index(e, j) + 1
        groups.append((a[i:p], b[j:q]))
        i, j = p, q
    links, j = [], 0
    for i in range(len(a)):
        while eb[j] <= ea[i] - len(xs[i]):
            j += 1
        links += [(a[i], b[k]) for k in itertools.takewhile(lambda k: k < len(b) and eb[k] - len(ys[k]) < ea[i], itertools.count(j))]
    return a, b, groups, links


def expected_alignments(rows):
    found = [plain_alignment(t or "") for _, t in rows]
    docs = Counter(pair for f in found if f for pair in set(f[3]))
    best = {}
    for (x, _), n in docs.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (key, _), f in zip(rows, found, strict=True):
        if f is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((key, len(a), len(b), len(groups), len(links), sum(docs[p] == best[p[0]] for p in links), sum(docs[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("head", [None, 300, 0])
def test_alignments_equal_brute_force(spark, small, head):
    """Whole documents and odd texts, with all, some and none of the pairs among the frequent ones."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").limit(60).collect()
    rows = [(r.doc_id, r.text) for r in docs] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "some text"), (2000, None), (docs[0].doc_id, docs[0].text)]
    got = cross_tokens.cross_alignment(spark.createDataFrame([(*r, 1, "c", 2, 0.5, "s") for r in rows], CLASH).repartition(3), queries.BYTE_BPE, queries.PIECES, head)
    assert got.columns == COLUMNS
    assert rows_of(COLUMNS, [tuple(r) for r in got.collect()]) == rows_of(COLUMNS, expected_alignments(rows))


def test_the_transducer_keeps_its_rest():
    steps = cross_tokens.Transducer([b"ab", b"c", b"abcd", b"e"], [b"a", b"bc", b"d", b"e", b"abc"])
    ends, xs, ys = steps.run([0, 1, 3], [0, 1, 3])
    assert ends == [(2, 2), (3, 3)] and list(zip(xs, ys, strict=True)) == [(0, 0), (0, 1), (1, 1), (3, 3)]
    assert steps.run([2], [4, 2])[0] == [(1, 2)]
    assert steps.run([0], [4]) is None and steps.run([2], [4]) is None and steps.run([1], [3]) is None and steps.run([], []) == ([], [], [])
    assert steps.run([3], [3, 3]) is None


def test_alignments_without_documents(spark):
    got = cross_tokens.cross_alignment(spark.createDataFrame([], "doc_id long, text string"), queries.BYTE_BPE, queries.PIECES)
    assert got.columns == COLUMNS and got.collect() == []


# --- the additive model


def test_scores_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op13_quality_classifier(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").count()
    assert len(got) == docs
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{d}/labels.parquet").collect()]
    held = [(got[i], q) for i, q in labels if i in got and zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r.held_out for r, _ in held) and sum(r.held_out for r in got.values()) == sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in got)
    assert sum(r.predicted == q for r, q in held) >= 0.9 * len(held)
    good, bad = [r.score for r, q in held if q], [r.score for r, q in held if not q]
    assert sum(x > y for x in good for y in bad) >= 0.97 * len(good) * len(bad)


def test_scores_follow_the_tables(spark):
    """A score is the sum of looked-up numbers, feature by feature and pair by pair."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0.3) | ((x[:, 1] > 0) != (x[:, 2] > 0)) & (x[:, 0] > -1)).astype(float)
    m = gam.fit(x, y)
    assert (1, 2) in m.pairs or (2, 1) in m.pairs  # an interaction that no single feature shows
    assert ((m.score(x) > 0.5) == (y > 0.5)).mean() > 0.9
    for row, p in zip(x[:20], m.score(x[:20]), strict=True):
        odds = m.intercept + sum(m.tables[f][sum(c <= row[f] for c in m.cuts[f])] for f in range(4))
        odds += sum(t[sum(c <= row[a] for c in m.coarse[a]), sum(c <= row[b] for c in m.coarse[b])] for (a, b), t in zip(m.pairs, m.pair_tables, strict=True))
        assert abs(1 / (1 + np.exp(-odds)) - p) < 1e-12


def test_features_are_what_they_say():
    texts = ["The cat.\nthe CAT the the 12 a", "", "É | é!", "x" * 5000]
    one = dict(zip(gam.FEATURES, gam.features(pa.array(texts))[0], strict=True))
    words = texts[0].lower().split()
    assert one["distinct_words"] == len(set(words)) / len(words) and one["repeated_words"] == 1 / 8 and one["one_letter"] == 1 / 8 and one["capitalised"] == 2 / 8 and one["capitals"] == 1 / 8 and one["line_ends"] == 1 / 2
    alone = np.stack([gam.features(pa.array([t]))[0] for t in texts])
    assert np.array_equal(alone, gam.features(pa.array(texts))) and np.isfinite(alone).all()


def test_scores_of_odd_tables(spark):
    rng = random.Random(4)
    good = " ".join(rng.choice(["tree", "river", "stone,", "light."]) for _ in range(90))
    rows = [(i, good if i % 2 else "| # | " * 40) for i in range(60)] + [(None, good), (100, None), (100, None), (101, ""), (102, good * 400)]
    docs = spark.createDataFrame([(*r, 1, "c", 2, 0.5, "s") for r in rows], CLASH)
    labels = spark.createDataFrame([(i, i % 2, "t") for i in range(60)] + [(None, 1, "t"), (3, None, "t"), (5, 7, "t"), (7, 0, "t"), (7, 1, "t"), (999, 1, "t")], "doc_id long, quality int, text string")
    got = gam.quality_scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got) and [r.held_out for r in got if r.doc_id is None] == [False]
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[102] > 0.5 and min(by_id[i] for i in range(1, 60, 2)) > max(by_id[i] for i in range(0, 60, 2)) and len({r.score for r in got if r.doc_id in (100, 101)}) == 1
    assert [r.score for r in gam.quality_scores(docs, labels.limit(0)).collect()] == [0.5] * len(rows)
    assert gam.quality_scores(docs.limit(0), labels).collect() == []
