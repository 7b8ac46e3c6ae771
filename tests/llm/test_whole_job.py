"""Each operator over all of its rows."""

import zlib

import corpus_pipeline as cp
from folioscope.llm import decontaminate, html_extract, langid, lm_score, queries, warc


def test_lm_learns_from_every_training_document(spark, monkeypatch):
    """Of documents of one piece each, every training one moves the embedding of its piece."""
    from folioscope.llm.attention import Model

    kept, fit = [], lm_score.fit
    monkeypatch.setattr(lm_score, "fit", lambda *a: kept.append(fit(*a)) or kept[-1])
    monkeypatch.setattr(lm_score, "FIT_STEPS", 8)
    monkeypatch.setattr(lm_score, "CELL_TOKENS", 100, raising=False)
    monkeypatch.setattr(lm_score, "CELL_GROWTH", 1, raising=False)
    pieces = lm_score.Pieces.shared(queries.PIECES)
    own = [k for k in range(pieces.size) if (p := pieces.model.id_to_piece(k)).startswith("▁") and p[1:].isascii() and p[1:].islower() and pieces.model.encode(p[1:]) == [k]][:1500]
    assert len(own) == 1500
    docs = spark.createDataFrame([(i, pieces.model.id_to_piece(k)[1:]) for i, k in enumerate(own)], "doc_id long, text string")
    assert lm_score.lm_scores(docs, queries.PIECES).where("score < 0").count() == 1500
    (model,) = kept
    moved = (model.p["E"] != Model(model.vocabulary).p["E"]).any(1)
    assert all(moved[k + 1] for i, k in enumerate(own) if zlib.crc32(str(i).encode()) % 7 != 2)


def test_lm_takes_frequent_words_whole(spark, monkeypatch):
    """A frequent word is one id to train on and to score, a rare one is spelled, and all documents are scored."""
    import numpy as np

    kept, fit = [], lm_score.fit
    monkeypatch.setattr(lm_score, "fit", lambda seq, counts, scratch: kept.append((counts, sorted(np.frombuffer(r.ids, np.uint16).tolist() for r in seq.collect()))) or fit(seq, counts, scratch))
    monkeypatch.setattr(lm_score, "FIT_STEPS", 8)
    pieces = lm_score.Pieces.shared(queries.PIECES)
    common, rare = "qzxvwkqq", "wqjzzxkv"
    spelled = pieces.model.encode(rare)
    assert len(pieces.model.encode(common)) > 1 and len(spelled) > 1
    docs = spark.createDataFrame([(i, f"{common} {common}") for i in range(200)] + [(1000 + i, rare) for i in range(7)], "doc_id long, text string")
    out = lm_score.lm_scores(docs, queries.PIECES).collect()
    assert sum(r.n_tokens for r in out) == 200 * 3 + 7 * 2 and all(-200 < r.score < 0 for r in out)
    ((counts, texts),) = kept
    train = [i for i in [*range(200), *range(1000, 1007)] if zlib.crc32(str(i).encode()) % 7 != 2]
    assert len(texts) == len(train)
    assert {tuple(x) for x in texts} == {tuple([*spelled, pieces.end]), (own := next(x[0] for x in texts if x[0] >= pieces.size), own, pieces.end)}
    assert counts[own] == 2 * sum(i < 200 for i in train) and counts.sum() == sum(map(len, texts))


def test_lm_rounds_read_their_own_documents(spark, monkeypatch):
    """The training documents lie by round, all of them once, so that a round doesn't read the others."""
    from pyspark.sql import functions as F

    kept, fit = [], lm_score.fit
    monkeypatch.setattr(lm_score, "fit", lambda seq, counts, scratch: kept.extend(seq.withColumn("file", F.input_file_name()).collect()) or fit(seq, counts, scratch))
    monkeypatch.setattr(lm_score, "FIT_STEPS", 8)
    docs = spark.createDataFrame([(i, f"word{i} and more") for i in range(300)], "doc_id long, text string")
    assert lm_score.lm_scores(docs, queries.PIECES).where("score < 0").count() == 300
    assert len(kept) == sum(zlib.crc32(str(i).encode()) % 7 != 2 for i in range(300)) and len({r.key for r in kept}) == len(kept)
    assert {r.round for r in kept} == set(range(lm_score.ROUNDS))
    assert all(r.round == r.key % lm_score.ROUNDS and f"/round={r.round}/" in r.file for r in kept)


def test_lm_spells_a_word_once(monkeypatch):
    """Ids are those of each word by itself, whichever batch a word came in, and a known word isn't spelled again."""
    import numpy as np
    import pyarrow as pa
    from folioscope.llm.wordhash import SPACE_FOLDED, words

    pieces = lm_score.Pieces(lm_score.vocabulary_path(queries.PIECES))
    monkeypatch.setattr(lm_score.Pieces, "LATE", 20, raising=False)
    encode, asked = pieces.model.encode, []
    pieces.model.encode = lambda texts, **kw: asked.extend(texts) or encode(texts, **kw)
    rng = np.random.default_rng(3)
    vocabulary = [f"{a}{b}" for a in ("été", "ab", "qzx", "中", "\u200b") for b in ("", "ing", "!", "77")]
    for _ in range(12):
        batch = [[vocabulary[k] for k in rng.integers(0, len(vocabulary), n)] + [f"new{rng.integers(10**6)}"] for n in (0, 3, 9)]
        ids, size, n_tokens, distinct, kind = pieces.stream(words(pa.array([" ".join(t) for t in batch]), SPACE_FOLDED))
        expected = [x for t in batch for x in [*(encode(w) or [0] for w in t), [pieces.end]]]
        assert ids.tolist() == [k for x in expected for k in x] and size.tolist() == [len(x) for x in expected] and n_tokens.tolist() == [len(t) + 1 for t in batch]
        w = words(pa.array([" ".join(t) for t in batch]), SPACE_FOLDED)
        assert np.array_equal(distinct[kind], np.insert(w.hashes, w.first[1:], lm_score.END_HASH))
    assert len(asked) == len(set(asked)) and len(pieces.known) > 20


def test_pipeline_stages_judge_rows_not_ids(spark, monkeypatch):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    docs = spark.createDataFrame([(1, a), (1, b), (2, b), (None, c), (None, c), (None, d), (7, d)], "doc_id long, text string")
    kept = cp.ngram_jaccard_join(spark, docs, "")
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, a), (1, b), (None, c), (7, d)], key=str)
    bench = spark.createDataFrame([(1, a), (2, c)], "item_id long, text string")
    rows = spark.createDataFrame([(1, a), (1, b), (None, c), (None, d)], docs.schema)
    for block in (decontaminate.BLOCK_BYTES, 8):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        assert sorted(r.text for r in decontaminate.keep_uncontaminated(rows, bench).collect()) == [b, d]


def test_html_keeps_text_after_and_inside_what_is_no_raw_element():
    whole = lambda inside: html_extract.extract(f"<article><p>One sentence that is long enough to stay.</p>{inside}<p>Two sentences, long enough to stay as well.</p></article>")
    for empty in ('<svg class="i"/>', "<svg/>", "<math/>", "<svg-icon></svg-icon>", "<title-card></title-card>", "<svg><text>drawn</text></svg>"):
        assert "Two sentences" in whole(empty) and "drawn" not in whole(empty), empty
    assert "E=m" in whole("<p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi></math> here, as everyone knows.</p>")
    assert "fallback text" in whole("<p>Some <object data='x'>fallback text</object> that is shown to all.</p>")


def test_warc_revisits_only_own_payload(spark):
    pages = spark.createDataFrame([(7, "u", "a"), (7, "u", "b"), (8, "u", "a"), (None, "u", "a"), (None, "u", "c")], "page_id long, url string, html string")
    got = {(r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_round_trip(pages).collect()}
    a, b, c = (warc.digest_of(x) for x in (b"a", b"b", b"c"))
    assert got == {(7, a, "revisit", 8), (7, b, "response", None), (8, a, "response", None), (None, a, "revisit", 8), (None, c, "response", None)}


def test_languages_have_their_own_share(spark, monkeypatch):
    monkeypatch.setattr(langid, "FIT_DOCS", 30)
    rows = [(k, "en", f"big large huge word{k}") for k in range(1000)] + [(1030, "es", "casa perro gato"), (1031, "es", "casa perro")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert {"casa", "perro", "gato", "big"} <= set(model.known) and 4 < len(model.known) < 80
