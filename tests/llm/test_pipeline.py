"""Each stage of the pipeline on its own input, against the operators' brute-force meaning."""

import re

import corpus_pipeline as cp
from folioscope.llm import langid, quality


def test_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").cache()
    bench = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    before = docs
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, before, small)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        source = {r.doc_id: r for r in before.collect()}
        if name == "quality_rules":
            kept = {r.doc_id: r.clean_text for r in quality.quality_rules(before).where("kept").collect()}
            assert {r.doc_id: r.text for r in out.collect()} == kept and all(r.n_chars == len(r.text) for r in out.collect())
        elif name == "language_id":
            assert ids == {r.doc_id for r in langid.language_id(before).where(f"lang_pred <> 'und' and score >= {langid.MIN_SCORE}").collect()}
        elif name == "ngram_jaccard_join":
            sets = {}
            for i, r in source.items():
                w = re.findall(r"[^\x20\x09-\x0D]+", r.text.lower())
                sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
            link = lambda a, b: 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])
            gone = set(source) - ids
            assert all(any(link(g, x) for x in source if x != g) for g in gone)
            assert not any(link(a, b) for a in ids for b in ids if a < b)
        elif name == "benchmark_decontamination":
            words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
            grams = {tuple(w[k : k + 10]) for w in map(words, bench) for k in range(len(w) - 9)}
            dirty = {i for i, r in source.items() if any(tuple(words(r.text)[k : k + 10]) in grams for k in range(len(words(r.text)) - 9))}
            assert ids == set(source) - dirty
        else:
            assert ids == set(source)
        before = out


def test_stages_on_nothing(spark, small):
    none = spark.read.parquet(f"{small}/documents.parquet").where("false")
    for name, stage in cp.STAGES:
        assert stage(spark, none, small).count() == 0, name
