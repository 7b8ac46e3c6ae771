"""The record store, sinks, passes, orders and node scores over small cases."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from folioscope.operators import entail, evaluation, extract, health, ordering, passes, reports
from folioscope.sources import sinks, store

A, B, C = "a" * 64, "b" * 64, "c" * 64


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_bodies_and_reviews(spark, tmp_path):
    files = spark.createDataFrame([(f"{A}.md", 1), (f"{A}.v2.md", 2), (f"v1/{A}.md", 3), (f"v1/{B}.v2.md", 4), (f"{C}.v3.md", 5), ("notes.md", 6)], "path string, size int")
    assert rows(store.bodies(files), "hash", "path") == [(A, f"{A}.md")]
    assert rows(store.bodies(files, raw=True), "hash", "size") == [(A, 2), (B, 4)]
    side = spark.createDataFrame([(f"{A}.review.json", '{"coverage": 1}'), (f"v1/{B}.review.json", "not json"), (f"{B}.review.json", "{}"), (f"{C}.review.json", "[1]")], "path string, value string")
    got = dict(rows(store.reviews(spark.createDataFrame([(f"{A}.v2.md",), (f"v1/{A}.md",), (f"v1/{B}.v2.md",), (f"{C}.md",), ("x.md",)], "path string"), side), "path", "review"))
    assert got == {f"{A}.v2.md": '{"coverage": 1}', f"v1/{A}.md": '{"coverage": 1}', f"v1/{B}.v2.md": None, f"{C}.md": None, "x.md": None}
    (tmp_path / "v1").mkdir()
    (tmp_path / "v1" / "one.md").write_bytes(b"caf\xc3\xa9")
    (tmp_path / "two.md").write_bytes(b"\xff")
    assert rows(store.listing(spark, str(tmp_path)), "path", "size") == [("two.md", 1), ("v1/one.md", 5)]
    assert dict(rows(store.hashed(spark, str(tmp_path) + "/*.md"), "name", "value")) == {"two.md": None}


def test_sidecar_words_and_passages(spark):
    side = spark.createDataFrame([("r", '{"segments": [{"start": 1.5, "words": [{"w": "Hello, you", "start": 2.0}, {"w": "there"}]}, {"words": [{"w": "x"}]}]}'), ("s", "{}"), ("t", None)], "record_key string, value string")
    assert rows(store.sidecar_words(side), "record_key", "pos", "word", "at") == [("r", 0, "hello", 2.0), ("r", 1, "you", 2.0), ("r", 2, "there", 1.5), ("r", 3, "x", 0.0)]
    long = "This passage is long enough to be kept as one claim."
    body = "{{highlight-start: a1}}" + long + "{{highlight-end: a1}} and {{highlight-start: b2}}short{{highlight-end: b2}} {{highlight-start: a1}}<!-- no -->more{{highlight-end}}"
    assert rows(store.swept_passages(spark.createDataFrame([("r", body)], "record_key string, body string")), "unit_id", "text") == [("a1", long + " [...] more")]


def test_strict_records(spark):
    good = f"---\ncontent_hash: sha256:{A}\n---\nbody"
    recs = spark.createDataFrame([("one", good, "s1"), ("two", good.replace(A, B), "s2"), ("three", "no fence", "s3")], "name string, value string, sha256 string")
    files = spark.createDataFrame([(f"{A}.md", "s1"), (f"{B}.md", "s2"), (f"v1/{B}.md", "s2")], "path string, sha256 string")
    assert rows(store.strict_violations(recs, files), "key", "rule") == [("three", "bytes"), ("three", "candidate"), ("three", "fence"), ("three", "hash"), ("two", "candidate")]


def test_sinks(spark, tmp_path):
    ddl = "record string, model string, prompt_sha8 string, run_label string, variant_only boolean, extracted_at string, passes array<struct<version:string>>, doc string"
    digests = spark.createDataFrame([("r", "m", "01234567", "", False, "2024", [("1",)], "old"), ("r", "n", "01234567", "", False, "2025", [("1",)], "new"), ("r", "m", "01234567", "try", False, "2026", [("1",)], "labelled"), ("s", "m", "89abcdef", "", False, "2024", [("override",)], "own")], ddl)
    sinks.write_digests(digests, str(tmp_path / "variants"), str(tmp_path / "canonical"))
    assert rows(spark.read.parquet(str(tmp_path / "variants")), "doc", "run_kind") == [("labelled", "variant"), ("new", "production"), ("old", "variant"), ("own", "variant")]
    assert rows(spark.read.parquet(str(tmp_path / "canonical")), "record", "doc") == [("r", "new")]
    plan = spark.createDataFrame([("r", "title", "A", "B")], "record string, field string, old string, new string")
    now, notes = sinks.refreshed(spark.createDataFrame([("r", "A"), ("s", "C")], "record string, title string"), plan, ["title"], "2024-01-01")
    assert rows(now, "record", "title") == [("r", "B"), ("s", "C")] and rows(notes, "record", "action") == [("r", "refresh")]
    report = spark.createDataFrame([("a|b", 0.5), ("c", None)], "name string, rate double").coalesce(1)
    for at in ("1", "2"):
        sinks.append_history(report, str(tmp_path / "history"), at)
    sinks.write_json(report, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "history")).count() == 4 and spark.read.json(str(tmp_path / "report")).count() == 2
    assert sinks.markdown(report) == "| name | rate |\n| - | - |\n| a\\|b | 0.5 |\n| c |  |"
    with pytest.raises(ValueError):
        sinks.markdown(report, 1)


ROUND = "record_key string, chunk int, round int, pos int, complete boolean, identity string, item struct<name:string,kind:string,title:string,content:string,type:string,attestation:string,speaker:string,source_id:string>"


def rounds(spark, items):
    names = ("name", "kind", "title", "content", "type", "attestation", "speaker", "source_id")
    return spark.createDataFrame([("r", c, n, p, done, None, tuple(x.get(k) for k in names)) for c, n, p, done, x in items], ROUND)


def test_passes(spark):
    chunks = spark.createDataFrame([("r", 0), ("r", 1)], "record_key string, idx int")
    name = lambda n: {"name": n}
    nodes = rounds(spark, [(0, 0, 0, False, name("A")), (0, 0, 1, False, name("B")), (0, 1, 0, False, name("C")), (0, 2, 0, False, name("D")), (1, 0, 0, False, name("A")), (1, 0, 1, False, name("E"))])
    assert rows(passes.nodes_pass(chunks, extract.Canned(nodes)), "chunk", "round", "item") == sorted([(0, 0, r.item) for r in nodes.collect()[:2]] + [(0, 1, nodes.collect()[2].item), (1, 0, nodes.collect()[5].item)], key=repr)
    said = lambda t, s, k="observation": {"content": t, "type": k, "attestation": "first_hand", "speaker": s, "source_id": s}
    claims = rounds(spark, [(0, 0, 0, False, said("It flew. ", "Ann")), (0, 0, 1, False, said("it FLEW.", "ann")), (0, 0, 2, False, said("It flew.", "Bob"))])
    assert passes.claims_pass(chunks, extract.Canned(claims)).count() == 2
    assert passes.sourced_claims_pass(chunks, extract.Canned(claims)).count() == 3
    cast = rounds(spark, [(0, 0, 0, False, {"name": "A", "kind": "person"}), (0, 1, 0, False, {"name": "A", "kind": "source"}), (0, 2, 0, False, {"name": "A", "kind": "person"}), (0, 3, 0, False, {"name": "Z", "kind": "person"})])
    assert rows(passes.cast_pass(chunks, extract.Canned(cast)), "round") == [(0,), (1,)]
    told = rounds(spark, [(0, 0, 0, False, {"title": "One"}), (0, 1, 0, False, {"title": " One "}), (0, 1, 1, False, {"title": "Two"}), (0, 2, 0, False, {"title": " "}), (0, 3, 0, False, {"title": "Late"})])
    assert rows(passes.accounts_pass(chunks, extract.Canned(told)), "identity") == [("One",), ("Two",)]


def test_prompt_texts_and_answers(spark):
    rec = spark.createDataFrame([("T", ["Ann", "Bob"], "1990", "ebook"), (None, None, None, None)], "title string, creators array<string>, date string, kind string")
    a, b = (r[0] for r in rec.select(passes.record_line(F.col("title"), F.col("creators"), F.col("date"), F.col("kind"))).collect())
    assert a.startswith('SOURCE RECORD: "T" (ebook) by Ann, Bob dated 1990.\n') and "Ann, Bob" in a.split("\n")[1] and b == "SOURCE RECORD: an untitled record.\n\n"
    nodes = spark.createDataFrame([("r", "person", "Bo"), ("r", "person", "Al"), ("r", "place", "X")], "record_key string, node_type string, name string")
    assert passes.directories(nodes).first().directory == "person: Al, Bo\nplace: X"
    assert passes.exclusions(spark.createDataFrame([("r", "b"), ("r", "a")], "record_key string, identity string")).first().excluded == "  - a\n  - b"
    raw = spark.createDataFrame([("1", '```json\n{"a": 1}\n```'), ("2", '{"structured_output": [1]} and more'), ("3", "sorry"), ("4", None)], "id string, raw string")
    assert rows(passes.repaired(raw), "id", "doc", "issue") == [("1", '{"a": 1}', None), ("2", "[1]", None), ("3", None, "malformed_json"), ("4", None, "malformed_json")]


def test_orders(spark):
    df = spark.createDataFrame([("a", 0.5, None, 1.0, 30), ("b", None, 0.9, None, 10), ("c", 0.9, 0.2, 0.5, 20)], "k string, recall double, fidelity double, cost double, size int").withColumn("coverage", F.col("recall"))
    order = lambda d: [r.k for r in d.collect()]
    assert order(ordering.by_recall(df, "k")) == ["c", "a", "b"] and order(ordering.by_coverage(df, "k")) == ["c", "a", "b"]
    assert order(ordering.by_cost(df, "k")) == ["c", "a", "b"] and order(ordering.by_size(df, "k")) == ["b", "c", "a"]
    many = spark.range(100).withColumn("g", F.col("id") % 3)
    assert rows(ordering.examples(many, ["g"], ["id"], 2), "id") == [(0,), (1,), (2,), (3,), (4,), (5,)]
    one, two = (rows(ordering.sample(many.repartition(n), "id", 10, 7), "id") for n in (1, 5))
    assert one == two and len(one) == 10
    texts = spark.createDataFrame([(i, "x" * (i * 7 % 50)) for i in range(100)], "i int, t string").coalesce(1)
    seen = ordering.length_sorted(texts, "t", lambda d: pd.DataFrame({"i": d["i"], "most": d["t"].str.len().max()}), "i int, most int", 10).collect()
    assert [r.i for r in seen] == list(range(100)) and sum(r.most - r.i * 7 % 50 for r in seen) < 500
    assert df.select(ordering.shortened(F.lit("abcdef"), 3)).first()[0] == "abc"


def test_node_score(spark):
    gold = spark.createDataFrame([("people", 1, "Ann Lee", ["Lee, Ann"]), ("person", 2, "Bob", None), ("event", 3, "Great storm of 1987 in Kent", ["The big storm of 1987"]), ("event", 4, "Kent storm", None)], "type string, golden_id int, canonical string, aliases array<string>")
    found = spark.createDataFrame([("person", 1, "Dr. Lee, Ann (pilot)"), ("persons", 2, "President Bob"), ("person", 3, "Robert"), ("person", 4, "the author"), ("events", 5, "Storm of 1987"), ("event", 6, "big storm 1987 aftermath"), ("event", 7, "storm"), ("place", 8, "storm of 1987")], "type string, ext_id int, name string")
    deny = spark.createDataFrame([("people", "Author")], "type string, name string")
    assert dict(rows(evaluation.matched_nodes(found, gold), "ext_id", "golden_id")) == {1: 1, 2: 2, 3: None, 4: None, 5: 3, 6: 3, 7: None, 8: None}
    got = {r.type: r for r in evaluation.node_score(found, gold, deny).collect()}
    person, all_ = got["person"], got["*"]
    assert (person.must_find, person.matched, person.recall, person.extracted, person.deny_hits, person.uncurated) == (2, 2, 1.0, 4, 1, 1)
    assert (all_.must_find, all_.matched, all_.extracted, all_.deny_hits, all_.uncurated, all_.recall, all_.precision) == (4, 3, 8, 1, 3, 0.75, 0.875)
    assert got["place"].recall is None
    labels = spark.createDataFrame([(1, "a"), (2, "b"), (9, "z")], "idx int, name string")
    assert rows(evaluation.label_drift(spark.createDataFrame([(1, "a"), (2, "x")], "idx int, name string"), labels), "idx", "problem") == [(2, "name drifted"), (9, "unknown index")]


def test_cascade_runs_the_second_classifier_on_its_rows_alone(spark):
    ddl = "id int, text string, quote string, window string, entailment struct<label:string,score:double,premise:string>"
    claims = spark.createDataFrame([(1, "a b", "a b", "a b", None), (2, "a b c d e", "a x", "a b c d", None), (3, "a b c d e", "a x", None, None), (4, " ", "a", "a", None), (5, "a", "b", "b", ("entails", 0.9, "quote")), (6, "a b c d e", "a x", "a b c d", ("neutral", 0.2, "quote"))], ddl)
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def counted(premise: pd.Series, hypothesis: pd.Series) -> pd.Series:
        seen.add(len(premise))
        return pd.Series([len(set(h.split()) & set(p.split())) / len(set(h.split())) for p, h in zip(premise, hypothesis, strict=True)])

    got = dict((i, (x, p)) for i, x, p in rows(entail.cascade(claims, "text", "quote", "window", counted), "id", "label", "premise"))
    assert got == {1: ("entails", "quote"), 2: ("entails", "window"), 3: ("neutral", "quote"), 4: (None, None), 5: ("entails", "quote"), 6: ("neutral", "quote")}
    assert dict(rows(entail.cascade(claims, "text", "quote", "window", force=True), "id", "label"))[5] == "contradicts"
    assert dict(rows(entail.cascade(claims, "text", "quote", "window", redo_unlocated=True), "id", "label"))[6] == "entails"
    assert entail.counts(entail.cascade(claims, "text", "quote", "window"), "quote", "text", "window").first().asDict() == {"assessed": 5, "ineligible": 1, "unlocated": 1}


def test_small_reports(spark):
    states = spark.createDataFrame([("a", "record_changed"), ("a", "record_changed"), ("b", "current"), ("c", "prep_version")], "record string, state string")
    assert rows(health.stale_records(states), "record") == [("a",), ("c",)]
    claims = spark.createDataFrame([("r", "c1", "d", "domain"), ("r", "c1", "d", "infrastructure"), ("s", None, "e", None)], "record_key string, claim_id string, digest_key string, category string")
    assert rows(reports.claim_id_violations(claims), "key", "rule") == [("r/c1", "duplicate id"), ("s", "claim_id")]
    assert rows(reports.category_counts(claims), "digest_key", "domain", "infrastructure") == [("d", 1, 1), ("e", 0, 0)]
    deltas = spark.createDataFrame([("a", 0.01, "aligned", 1.0), ("b", -12.0, "ambiguous", 0.6), ("c", None, "unaligned", None)], "k string, delta double, state string, coverage double")
    r = reports.delta_buckets(deltas).first()
    assert (r.exact, r.beyond, r.covered_99, r.covered_50) == (0.5, 0.5, 1 / 3, 2 / 3) and abs(r.ambiguous - 1 / 3) < 1e-9
    assert [x.k for x in reports.worst_deltas(deltas, most=1).collect()] == ["b"]


def test_inputs(tmp_path):
    import json

    from folioscope.sources import inputs

    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.yaml").write_text("claims: []")
    (tmp_path / "set.json").write_text(json.dumps({"schema": inputs.MANIFEST, "predictions": {"a": "sub/a.yaml", "b": "../x.yaml", "c": "/x.yaml"}}))
    got = inputs.predictions(tmp_path / "set.json", ["a", "b"], "a")
    assert got["a"][0] == {"claims": []} and len(got["a"][1]) == 64
    assert list(inputs.predictions(tmp_path / "sub" / "a.yaml", ["z"])) == ["z"]
    for cases, only in ((["b"], None), (["c"], None), (["d"], None), (["a"], "q")):
        with pytest.raises(ValueError):
            inputs.predictions(tmp_path / "set.json", cases, only)
    with pytest.raises(ValueError):
        inputs.predictions(tmp_path / "sub" / "a.yaml", ["y", "z"])
    (tmp_path / "registry.yaml").write_text("nodes: {active: 3, file: n.txt}")
    (tmp_path / "n.txt").write_text("hello")
    pinned = inputs.Pinned.read(str(tmp_path), {})
    (tmp_path / "n.txt").write_text("changed")
    assert pinned.passes["nodes"]["text"] == "hello" and pinned.provenance()[0]["version"] == "3"
    with pytest.raises(TypeError):
        pinned.passes["nodes"]["text"] = "x"
    key = inputs.register(tmp_path / "reg", {"b": 1, "a": [1]})
    assert inputs.register(tmp_path / "reg", {"a": [1], "b": 1}) == key and inputs.registered(tmp_path / "reg") == {key: {"a": [1], "b": 1}}
    old = tmp_path / "reg" / "configurations.json"
    old.write_text(json.dumps({key: {"a": [1], "b": 1}}))  # without a schema
    assert len({inputs.register(tmp_path / "reg", {"c": 2}), *inputs.registered(tmp_path / "reg")}) == 2
    old.write_text(json.dumps({key: {"a": [2]}}))
    with pytest.raises(ValueError):
        inputs.registered(tmp_path / "reg")
    base = tmp_path / "base.json"
    inputs.accept_baseline(base, {"dates": {"passed": 1, "total": 3}, "context": {"passed": 0, "total": 0}}, {"fixture": "f"}, "Ann")
    assert inputs.against_baseline(base, {"dates": {"passed": 2, "total": 3}, "context": {"passed": 0, "total": 0}}, {"fixture": "f"}) == {"context": "unchanged", "dates": "better"}
    assert inputs.against_baseline(base, {}, {"fixture": "f"}) == {"context": "unchanged", "dates": "worse"}
    with pytest.raises(ValueError):
        inputs.against_baseline(base, {}, {"fixture": "g"})
    assert set(inputs.fingerprints({"x": 1}, [tmp_path / "n.txt"], {})) == {"schema", "code", "config"}
