"""Very long texts, nulls in every column, clashing columns and repeated rows, for each operator and stage."""

import random

import corpus_pipeline as cp
import pytest

from folioscope.llm import decontaminate, langid, lm_score, ngram_join, packing, quality, queries, token_output, unigram, warc

WORDS = [f"{a}{b}{c}" for a in "bdgkmnprst" for b in "aeiou" for c in ("", "n", "r", "st", "ll")]


def prose(seed, n):
    rng = random.Random(seed)
    return "\n".join(" ".join(rng.choice(WORDS) for _ in range(12)) + "." for _ in range(n // 12))


LONG = prose(1, 60_000)
ROWS = [
    (1, LONG, "xx", "s", 5, "clash", 1, "clash"), (1, LONG, "xx", "s", 5, "clash", 1, "clash"), (2, prose(2, 240), "xx", None, None, None, None, None), (3, None, None, None, None, None, None, None),
    (None, prose(3, 240), "xx", "s", 1, "k", 2, "t"), (5, "", "xx", "", 0, "", 0, ""),
]
DDL = "doc_id long, text string, lang string, source string, n_chars int, key string, piece int, bucket string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DDL)


def test_long_texts_are_whole(spark, docs, monkeypatch):
    monkeypatch.setattr(lm_score, "FIT_STEPS", 8)
    n_words = len(LONG.split())
    of = lambda df: [r for r in df.collect() if r.doc_id == 1]
    assert [r.n_words for r in of(unigram.token_counts(docs, queries.PIECES))] == [n_words] * 2
    assert [r.n_words for r in of(quality.quality_rules(docs))] == [n_words] * 2
    assert [r.n_tokens for r in of(lm_score.lm_scores(docs, queries.PIECES))] == [n_words + 1] * 2
    sets = of(ngram_join.jaccard_classes(docs))
    plain = LONG.split()
    assert {r.n_shingles for r in sets} == {len({tuple(plain[i : i + 5]) for i in range(len(plain) - 4)})} and {r.component_id for r in sets} == {1}
    last = " ".join(plain[-10:])
    hit = of(decontaminate.decontaminate(docs, spark.createDataFrame([("i", last)], "item_id string, text string")))
    assert [(r.n_words, r.n_hit, r.contaminated) for r in hit] == [(n_words, 10, True)] * 2
    pieces = of(packing.best_fit_packing(docs, queries.WORD_BPE))
    sequences = of(token_output.training_order(docs, queries.WORD_BPE))
    assert sum(r.length for r in pieces) == sum(r.n_tokens for r in sequences) > 2 * n_words and len(pieces) > 20
    assert {r.lang_pred for r in of(langid.language_id(docs))} == {"xx"}


def test_a_long_page_is_one_record(spark):
    pages = spark.createDataFrame([(1, "u", LONG * 4, "clash"), (2, None, None, None)], "page_id long, url string, html string, digest string")
    assert {r.page_id: r.payload_bytes for r in warc.archive_round_trip(pages).collect()} == {1: 4 * len(LONG), 2: 0}


def test_stages_keep_the_columns(spark, docs, tmp_path):
    spark.createDataFrame([("i", "no such words at all")], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes, name
        kept = sorted(((r.doc_id, (r.text or "")[:20], r.bucket) for r in out.collect()), key=repr)
        clean = sorted(((r[0], (r[1] or "")[:20], r[7]) for r in ROWS if r[1]), key=repr)
        if name == "ngram_jaccard_join":  # of equal texts one row stays, and texts without words stand alone
            assert kept == sorted([(r[0], (r[1] or "")[:20], r[7]) for r in ROWS[1:]], key=repr)
        elif name == "benchmark_decontamination":
            assert len(kept) == len(ROWS)
        else:
            assert kept == clean, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert cp.best_fit_packing(spark, docs, str(tmp_path)).select("doc_id").distinct().count() == 5


def test_stages_take_columns_of_any_name(spark, docs, tmp_path):
    from pyspark.sql import functions as F

    spark.createDataFrame([("i", "no such words at all")], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    names = ["_row", "_text", "_id", "row", "number", "id", "component_id", "lang_pred", "kept", "x", "none"]
    odd = docs.select("*", *[F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))).alias(n) for n in names])
    for name, stage in cp.STAGES:
        out = stage(spark, odd, str(tmp_path))
        if name == "best_fit_packing":
            assert out.count() > 0
            continue
        assert out.columns == odd.columns and out.dtypes == odd.dtypes, name
        assert all(r[n] == n + ("?" if r.doc_id is None else str(r.doc_id)) for r in out.collect() for n in names), name
        assert {tuple(r) for r in out.drop("text", "n_chars", "lang", *names).collect()} == {tuple(r) for r in stage(spark, docs, str(tmp_path)).drop("text", "n_chars", "lang").collect()}, name


def test_items_without_an_id_hit_but_do_not_count(spark, docs):
    words = prose(2, 240).split()[:12]
    bench = spark.createDataFrame([(None, " ".join(words)), (None, None)], "item_id string, text string")
    (row,) = [r for r in decontaminate.decontaminate(docs, bench).collect() if r.doc_id == 2]
    assert (row.n_hit, row.n_items, row.contaminated) == (12, 0, True)
