"""Every operator against a brute-force version, an exact round trip or held-out accuracy."""

import hashlib
import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from folioscope.llm import decontaminate, html_extract, langid, lm_score, ngram_join, packing, quality, queries, scratch, token_output, unigram, warc
from folioscope.llm.subwords import WordBpe, vocabulary_path

from oracle import same

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = "der die das the of and casa rojo être où naïve zebra lamp stone river cloud".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 60)) for _ in range(n))


def odd_texts():
    rng = random.Random(9)
    base = [prose(rng, rng.randint(1, 90)) for _ in range(25)]
    near = []
    for t in base[:12]:
        w = t.split()
        for _ in range(3):
            v = list(w)
            if len(v) > 30:
                v[rng.randrange(len(v))] = "changed"
            near.append(" ".join(v))
    passage = prose(rng, 60)
    shared = [prose(rng, 15) + " " + passage + " " + prose(rng, 15) for _ in range(10)]
    odd = [None, "", "  \n\t", "one", "Two Words", "a b c d", "A b C D e", "a b c d e", "ÀÉ x y\x00z", "#*$ | <x> & %", "line\nline\nline\n\nline", prose(rng, 6000), "<|endoftext|> don't 😀 日本語", "x" * 5000]
    return base + near + shared + odd + base[:3] + [base[0].upper()]


TEXTS = odd_texts()


@pytest.fixture(scope="module")
def docs(spark):
    langs = ["en", "de", None, "fr"]
    rows = [(i, t, langs[i % 4], f"s{i % 3}", len(t or ""), "clash", i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, piece long")


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("doc_id < 0")


def rows_by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_ngram_join_is_exact(docs, nothing):
    got = rows_by_id(ngram_join.jaccard_classes(docs))
    sets = []
    for t in TEXTS:
        w = SPACE.findall((t or "").translate(UPPER))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(TEXTS)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == {i: (len(s), find(i)) for i, s in enumerate(sets)}
    assert ngram_join.jaccard_classes(nothing).count() == 0


def test_ngram_join_with_every_key_hot(spark, docs, monkeypatch):
    plain = sorted(map(tuple, ngram_join.jaccard_classes(docs).collect()))
    monkeypatch.setattr(ngram_join, "HOT_ROWS", 1)
    assert sorted(map(tuple, ngram_join.jaccard_classes(docs).collect())) == plain
    text = " ".join(f"w{k}" for k in range(30))
    odd = spark.createDataFrame([(None, text), (None, text + " more"), (4, text), (5, text + " more"), (None, "alone")], "doc_id long, text string")
    assert sorted(((r.doc_id, r.component_id) for r in ngram_join.jaccard_classes(odd).collect()), key=str) == sorted([(None, 4), (None, 4), (4, 4), (5, 4), (None, None)], key=str)


def test_tokens_that_agree_in_their_short_form_count_as_often_as_they_are():
    tokens = np.array([7, 7 + (1 << 32), 9, 11], np.uint64)  # the first two agree in 32 bits and in the bucket
    keys, n = np.array([1, 2], np.uint64), np.array([4, 4])
    pack = ngram_join._pack([(keys, n, np.concatenate([tokens, tokens]), n)], 4)
    again = ngram_join._pack([(keys[:1], n[:1], tokens, n[:1])], 4)
    rows = pa.Table.from_batches([b for b in ngram_join._common(iter([pack, again]))])
    assert Counter(zip(rows.column("key").to_pylist(), rows.column("token").to_pylist(), strict=True)) == {(1, 7): 2, (2, 7): 2, (1, 9): 1, (2, 9): 1, (1, 11): 1, (2, 11): 1}
    assert set(rows.column("df").to_pylist()) == {2}


def test_ngram_join_opens_groups_of_other_components(spark):
    """A chain whose links only the token-group matrix finds, and two groups that share much but do not link."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[s : s + 100]) for s in range(0, 120, 10)] + [" ".join(words[:60] + [f"z{rng.random()}" for _ in range(40)]) for _ in range(12)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_classes(df).collect()}
    assert {got[i] for i in range(12)} == {0}
    assert all(got[i] == i for i in range(12, 24))


def test_queries_against_sql(spark, small):
    for name, sql in queries.ORACLES.items():
        same(queries.QUERIES[name](spark, small), sql, small)


def test_quality_base_figures(docs, nothing):
    got = rows_by_id(quality.quality_rules(docs))
    for i, text in enumerate(TEXTS):
        t = text or ""
        w = SPACE.findall(t)
        at: dict = {}
        for k in range(len(w) - 7):
            at.setdefault(tuple(w[k : k + 8]), []).append(k)
        cover = {x for v in at.values() if len(v) > 1 for k in v for x in range(k, k + 8)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if SPACE.search(line):
                dup += line in seen
                seen.add(line)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover))
        assert r.base_failed == (len(w) < 20 or 100 * len(cover) > 30 * len(w))
        assert not (r.kept and r.base_failed)
    assert quality.quality_rules(nothing).count() == 0 and quality.keep_clean(nothing).columns == nothing.columns


def test_quality_rules_for_a_line():
    run_on = "word " * 30
    for line, times, why in [
        ("Short end", 1, "punctuation"), ("Short end.", 1, None), ("four words of text", 1, None), (run_on, 1, "punctuation"), (run_on + ".", 1, None), ("word, " * 13 + "word " * 13, 1, None),
        ("No. " * 15, 1, None), ("No. " * 16, 1, "punctuation"), ("Home | News | About", 1, "navigation"), ("read the next part of it", 2, None), ("read the next part of it", 3, "navigation"),
        ("Nous utilisons des cookies pour vous.", 1, "boilerplate"), ("Alle Rechte vorbehalten.", 1, "boilerplate"), ("BUY!! NOW!!", 1, "boilerplate"),
    ]:
        assert quality.line_failure(line, len(line.split()), times) == why, line


def test_quality_lines():
    text = "This is a sentence that stands by itself.\nHome | News | Sport | More\nAll rights reserved.\nAnother plain sentence ends here."
    cleaned, n, removed, lost, _ = quality.clean(text)
    assert cleaned == "This is a sentence that stands by itself.\nAnother plain sentence ends here." and (n, removed, lost) == (4, 2, 10)


def test_packing_round_trip(docs, nothing):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path(queries.WORD_BPE))
    rows = packing.best_fit_packing(docs, queries.WORD_BPE, 256).collect()
    expected = Counter()
    for i, text in enumerate(TEXTS):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k, s in enumerate(range(0, len(ids), 256)):
            part = ids[s : s + 256]
            expected[i, k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for o, n in sorted(places):
            assert o == end
            end += n
        assert end <= 256
    assert len(by) <= math.ceil(sum(r.length for r in rows) / 256) * 1.1 + 1
    assert packing.best_fit_packing(nothing, queries.WORD_BPE).count() == 0


def test_packing_plan_fills():
    rng = random.Random(2)
    for _ in range(20):
        counts = Counter(rng.randint(1, 40) for _ in range(rng.randint(1, 200)))
        lines = packing.plan(dict(counts), 40)
        used = Counter()
        for times, chosen in lines:
            assert sum(k * n for k, n in chosen.items()) <= 40
            for k, n in chosen.items():
                used[k] += n * times
        assert used == counts
        best = packing.fullest({3: 2, 7: 1}, 12)
        assert sum(k * n for k, n in best.items()) == 10


def test_bpe_words_equal_the_tokenizer():
    w = WordBpe.shared(queries.WORD_BPE)
    for t in [t for t in TEXTS if t] + ["I'LL don't", "ŁÓdź'S ĲŉſŁ İx", "a\x1cb c", "naïve​ x", "¼½ ª º µ", "é x"]:
        assert w.encode([t])[0] == w.whole(t)


def brute_hits(text, items):
    w = ALNUM.findall((text or "").translate(UPPER))
    cover, found = set(), set()
    for i, t in items:
        p = ALNUM.findall((t or "").translate(UPPER))
        m = min(10, len(p))
        for s in range(len(p) - m + 1) if m else ():
            for k in range(len(w) - m + 1):
                if w[k : k + m] == p[s : s + m]:
                    cover.update(range(k, k + m))
                    found.add(str(i))
    return len(w), len(cover), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def test_decontamination(spark, docs, nothing, monkeypatch):
    items = [(1, TEXTS[3]), (2, "a B c"), (3, None), (4, " ".join((TEXTS[20] or "").split()[2:14])), (10, "ÀÉ x"), (10, "one"), (5, "...")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = {i: brute_hits(t, items) for i, t in enumerate(TEXTS)}
    for block in (decontaminate.BLOCK_BYTES, 8):  # one block, and one for each item
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        got = rows_by_id(decontaminate.decontaminate(docs, bench))
        assert {k: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for k, r in got.items()} == expected
        kept = decontaminate.keep_uncontaminated(docs, bench)
        assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, e in expected.items() if not e[1]} and kept.columns == docs.columns
    assert decontaminate.decontaminate(nothing, bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.where("false")).where("contaminated").count() == 0


def test_language_id_held_out(spark, small, docs, nothing):
    d = spark.read.parquet(f"{small}/documents.parquet")
    got = langid.language_id(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(got) > 40 and sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    rows = rows_by_id(langid.language_id(docs))
    assert len(rows) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        assert rows[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= rows[i].score <= 1
        assert (rows[i].lang_pred == "und") == (not any(c.isalpha() for c in t or ""))
    assert langid.language_id(nothing).count() == 0 and langid.keep_recognised(docs).columns == docs.columns


def plain_language(train, text):
    """The prediction in plain arithmetic, from all (lang, text) of the training documents."""
    letters = lambda t: "".join(c if unicodedata.category(c)[0] == "L" else " " for c in t.lower()).split()
    langs = sorted({x for x, _ in train})
    tables = [{} for _ in range(5)]
    for lang, t in train:
        for w in letters(t):
            padded = f"_{w}_"
            for kind, g in [(0, w)] + [(n, padded[i : i + n]) for n in range(1, 5) for i in range(len(padded) - n + 1)]:
                tables[kind].setdefault(g, Counter())[lang] += 1
    total = [{x: sum(c[x] for c in t.values()) for x in langs} for t in tables]
    log = lambda kind, g, x: math.log((tables[kind][g][x] + 0.1) / (total[kind][x] + 0.1 * (len(tables[kind]) + 1)))
    sums, words_ = dict.fromkeys(langs, 0.0), letters(text)
    if not words_ or not langs:
        return "und", 0.0
    for w in words_:
        if w in tables[0]:
            for x in langs:
                sums[x] += log(0, w, x)
            continue
        padded, found = f"_{w}_", []
        for i in range(len(padded)):
            found += [(n, g) for n in range(4, 0, -1) if len(g := padded[i : i + n]) == n and g in tables[n]][:1]
        for x in langs:
            sums[x] += sum(0.9 ** (4 - n) * log(n, g, x) for n, g in found) / max(1, len(found))
    best = max(langs, key=lambda x: sums[x])
    return best, 1 / sum(math.exp((sums[x] - sums[best]) / math.sqrt(len(words_))) for x in langs)


def test_language_id_against_plain_arithmetic(spark):
    rng = random.Random(3)
    sound = {"aa": "ptkaio", "bb": "bdgeou", "cc": "ßéaoptñ"}
    word = lambda x: "".join(rng.choice(sound[x]) for _ in range(rng.randint(1, 6)))
    rows = [(i, " ".join(word(x) for _ in range(rng.randint(1, 12))), x) for i in range(90) for x in [rng.choice("aa bb cc".split())]]
    rows += [(100, "½ ² Ⅷ 12 _", "aa"), (101, "pt½ka Tk", "bb"), (102, None, "cc"), (103, "x" * 50_000 + " pot", None), (None, "Pa tk", "aa"), (104, "pa " * 3000, "aa"), (104, "pa " * 3000, "aa")]
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1 if i is not None else False
    train = [(x, t or "") for i, t, x in rows if x is not None and not held(i)]
    got = langid.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(rows)
    for r in got:
        for t in {t or "" for i, t, _ in rows if i == r.doc_id}:
            lang, score = plain_language(train, t)
            assert r.lang_pred == lang and math.isclose(r.score, score, rel_tol=1e-6), (r, t[:40])


def test_lm_scores(spark, docs, nothing, monkeypatch):
    monkeypatch.setattr(lm_score, "FIT_STEPS", 30)
    monkeypatch.setattr(lm_score, "HEAD_WORDS", 20)  # so that most words take the way over the lexicon's buckets
    models, fit = [], lm_score.fit
    monkeypatch.setattr(lm_score, "fit", lambda *a: models.append(fit(*a)) or models[-1])
    got = rows_by_id(lm_score.lm_scores(docs, queries.PIECES))
    tokens = [[*SPACE.findall((t or "").translate(UPPER)), None] for t in TEXTS]
    counts = Counter(w for i, t in enumerate(tokens) if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    total, distinct = sum(counts.values()), len(counts)
    for i, t in enumerate(tokens):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in counts for w in t), total)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in t), rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    pieces = lm_score.Pieces.shared(queries.PIECES)
    for i in sorted(range(len(tokens)), key=lambda i: len(tokens[i]))[:-4]:
        ids = [pieces.model.encode(w) or [0] if w is not None else [pieces.end] for w in tokens[i]]
        lp, at, expected = plain_scores(models[0], [x for p in ids for x in p]), 0, 0.0
        for w, p in zip(tokens[i], ids, strict=True):
            expected += math.log10(0.9 * math.exp(sum(lp[at : at + len(p)])) + 0.1 * counts[w] / total)
            at += len(p)
        assert math.isclose(got[i].score, expected, rel_tol=1e-4, abs_tol=1e-3), i
    assert lm_score.lm_scores(nothing, queries.PIECES).count() == 0


def plain_scores(model, ids):
    """The natural log probability of each id, one position at a time in plain arithmetic."""
    from folioscope.llm import attention as A

    p, v, out = {k: x.astype(float) for k, x in model.p.items()}, model.vocabulary, []
    before = [0, *(k + 1 for k in ids)]
    for at, y in enumerate(ids):
        first = at - at % A.STRIDE - (A.WINDOW - A.STRIDE)  # the window reaches before the text; there is the begin symbol
        seen = [before[j] if j > 0 else 0 for j in range(first, at + 1)]
        e = p["E"][seen]
        q, kv = e[-1] @ p["Wq"], e @ p["Wkv"]
        weight = np.exp(kv[:, : A.DIM] @ q + p["far"][np.arange(len(seen) - 1, -1, -1)])
        h = e[-1] + weight / weight.sum() @ kv[:, A.DIM :]
        g = h + np.maximum(h @ p["W1"], 0) @ p["W2"]
        share = lambda logits, k: logits[k] - np.log(np.exp(logits).sum())
        band, member = int(v.band[y]), int(v.member[y])
        g = np.append(g, 1.0)
        out.append(share(g @ p["U1"], band) + share(g @ p["U2"][band], member) + float(v.inside[y]))
    return out


def test_attention_is_causal_and_scores_once():
    from folioscope.llm.attention import WINDOW, Model, Vocabulary, windows

    rng = np.random.default_rng(0)
    ids = rng.integers(0, 50, 300)
    model = Model(Vocabulary(np.bincount(ids, minlength=60)))
    x, place, live = windows(ids, np.array([300]), WINDOW)
    loss = lambda: model.copy().train_step(x, ids[place], live, 0.0, {})
    before = loss()
    model.train(ids, np.array([300]), 60, 0.02, {})
    assert loss() < before - 1
    whole = model.score(ids, np.array([300]))
    assert np.allclose(whole, plain_scores(model, ids.tolist()), atol=1e-4)
    assert np.allclose(whole[:120], model.score(ids[:120], np.array([120])), atol=1e-4)
    split = model.score(ids, np.array([100, 200]))
    assert np.allclose(split[:100], whole[:100], atol=1e-4) and np.allclose(split[100:], model.score(ids[100:], np.array([200])), atol=1e-4)
    every = np.array([model.score(np.append(ids[:40], k), np.array([41]))[-1] for k in range(60)])
    assert abs(np.exp(every).sum() - 1) < 0.02


def test_attention_gradients():
    """A step's gradients, seen through its first moments, against differences of the loss."""
    from folioscope.llm.attention import WINDOW, Model, Vocabulary, windows

    rng = np.random.default_rng(1)
    ids = rng.integers(0, 40, 50)
    model = Model(Vocabulary(np.bincount(ids, minlength=40)))
    x, place, live = windows(ids, np.array([30, 20]), WINDOW)
    loss = lambda m: m.copy().train_step(x, ids[place], live, 0.0, {})
    state = {}
    model.train_step(x, ids[place], live, 0.0, state)
    for name in ("Wq", "Wkv", "W1", "W2", "U1", "U2", "far"):
        grad = state[name][0] * 10
        for at in [np.unravel_index(k, grad.shape) for k in np.argsort(-np.abs(grad), axis=None)[:3]]:
            sides = []
            for step in (0.02, -0.02):
                other = model.copy()
                other.p[name][at] += step
                sides.append(loss(other))
            assert math.isclose((sides[0] - sides[1]) / 0.04, grad[at], rel_tol=0.05, abs_tol=2e-4), (name, at)


def test_warc_round_trip(spark):
    rows = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/ü x\r\n", "<p>x</p>"), (3, None, None), (4, "u", ""), (9, "u", "é😀" * 3000), (-5, "u", "<p>x</p>"), (2, "dup", "<p>x</p>")]
    pages = spark.createDataFrame([(i, u, h, "clash") for i, u, h in rows], "page_id long, url string, html string, digest string")
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_round_trip(pages).collect())
    best: dict = {}
    for i, _, h in rows:
        best[h or ""] = max(best.get(h or "", i), i)
    expected = Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        top = best[h or ""]
        expected[i, len(raw), warc.digest_of(raw), "response" if i == top else "revisit", None if i == top else top] += 1
    assert got == expected
    assert warc.archive_round_trip(pages.where("false")).count() == 0


def test_warc_reads_coalesce():
    reads = warc.coalesce_ranges([(0, 10), (10, 5), (warc.GAP_BYTES + 100, 7), (10 * warc.GAP_BYTES, 1)])
    assert [(s, e, len(m)) for s, e, m in reads] == [(0, 15, 2), (warc.GAP_BYTES + 100, warc.GAP_BYTES + 107, 1), (10 * warc.GAP_BYTES, 10 * warc.GAP_BYTES + 1, 1)]


def test_token_counts_equal_the_tokenizer(docs, nothing):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.Unigram(unigram.zipf_vocabulary(vocabulary_path(queries.PIECES)), 0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace()])
    got = rows_by_id(unigram.token_counts(docs, queries.PIECES))
    for i, text in enumerate(TEXTS):
        assert got[i].n_tokens == len(t.encode(text or "", add_special_tokens=False).ids), text
    counter = unigram.Counter.shared(queries.PIECES)
    rng = random.Random(1)
    for _ in range(200):
        x = "".join(rng.choice("abé<>0x1 \n　日😀\x00\x1c/▁") for _ in range(40))
        assert counter.count(x)[1] == len(t.encode(x, add_special_tokens=False).ids)
    assert unigram.token_counts(nothing, queries.PIECES).count() == 0


def test_unigram_ties():
    """Equal scores: the longer last piece was tried first, and stays."""
    c = unigram.Counter([("a", -1.0), ("aa", -2.0), ("b", -1.0)])
    assert c.viterbi("aa") == (1, -2.0)


def test_training_order(spark, docs, nothing):
    for n in (1, 2, 3, 7, 1000, 65_537):
        assert sorted(token_output.feistel(np.arange(n), n)) == list(range(n))
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path(queries.WORD_BPE))
    manifest, root = token_output.write_shards(docs, queries.WORD_BPE, scratch.Scratch(spark, "t"), 64, 8)
    rows = token_output.read_shards(manifest, root, 64).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert all((r.shard, r.byte_offset) == (r.slot // 8, r.slot % 8 * 128) for r in rows)
    expected = Counter()
    for i, text in enumerate(TEXTS):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k, s in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[s : s + 64], "<u4")
            expected[i, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.n_tokens, r.ids_crc32) for r in rows) == expected
    assert token_output.training_order(nothing, queries.WORD_BPE).count() == 0


PAGE = """<html><head><title>No</title><style>p{}</style></head><body class="has-sidebar"><header><a href=/>Site</a></header>
<nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav><div class="cookie-notice">We use cookies to make this work for you every day.</div>
<article><h1>A &amp; B</h1><p>First <b>bold</b> para&nbsp;graph, with   space.<br>And more of it here.<p><b>Unclosed <i>tags go on until the paragraph ends.
<div class="comments"><p>I am a reader and this is my long comment, which has many words and ends.</p></div>
<p>Last paragraph &lt;tag&gt;.</p></article><aside><p>Related things that you may like to read some other day.</p></aside>
<form><label>Mail</label><input name=x></form><script>var t="</p><p>no";</script><!-- <p>no</p> --><footer>&copy; us</footer>"""


def test_html_extraction(spark):
    expected = "A & B\nFirst bold para graph, with space. And more of it here.\nUnclosed tags go on until the paragraph ends.\nLast paragraph <tag>."
    assert html_extract.extract(PAGE) == expected
    pages = spark.createDataFrame([(1, "u", PAGE, 1), (2, None, None, 1), (3, "u", "", 1), (4, "u", "plain words only, but enough of them to be taken for a text, as they end well.", 1), (None, "u", "<p", 1)], "page_id long, url string, html string, text int")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract_pages(pages).collect()}
    assert got[1] == (expected, len(expected)) and got[2] == got[3] == ("", 0) and got[4][1] > 0


def test_minimum_cut_against_all_labellings():
    rng = random.Random(8)
    for _ in range(150):
        n = rng.randint(1, 8)
        scores = [rng.choice([-3, -1, -0.5, 0.5, 1, 2.5]) for _ in range(n)]
        edges = {(i, j): rng.choice([0.25, 1.0, 2.0]) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}

        def cost(side):
            return sum(-s if s < 0 and x else s if s > 0 and not x else 0 for s, x in zip(scores, side, strict=True)) + sum(c for (i, j), c in edges.items() if side[i] != side[j])

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert abs(cost(html_extract.minimum_cut(scores, edges)) - best) < 1e-9


def test_components(spark):
    from folioscope.llm.components import components

    rng = random.Random(6)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(50)] + [(k, k + 1) for k in range(200, 260)] + [(500, k) for k in range(501, 540)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), scratch.Scratch(spark, "c"), "c").collect()}
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
