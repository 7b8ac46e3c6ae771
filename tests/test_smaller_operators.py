"""Operators that no query needs, each against a case worked out by hand."""

import pytest
from pyspark.sql import functions as F

from folioscope.functions import codes
from folioscope.functions import text as T
from folioscope.operators import accounts, dedup, entail, gold, graph, health, reports, validation
from folioscope.sources import digests


def one(spark, column, ddl, *values):
    return spark.createDataFrame([values], ddl).select(column.alias("x")).first().x


def got(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_text_helpers(spark):
    assert one(spark, T.straight_quotes(F.col("c")), "c string", "‘a’ “b”") == "'a' \"b\""
    assert one(spark, T.strip_speaker(F.col("c")), "c string", "Ann Lee: we saw: it") == "we saw: it" and one(spark, T.strip_speaker(F.col("c")), "c string", "we saw: it") == "we saw: it"
    body = "x" * 300 + " the {{mark}}span <!-- c --> ends " + "y" * 300
    assert one(spark, T.display_context(F.col("b"), F.col("s"), F.col("e"), 12), "b string, s int, e int", body, 305, 318) == "xxxxxxx the span e"
    assert one(spark, entail.window_text(F.col("b"), F.col("s"), F.col("e"), 3), "b string, s int, e int", "0123456789", 1, 4) == "0123456" and one(spark, entail.window_text(F.col("b"), F.col("s"), F.col("e"), 3), "b string, s int, e int", "0123456789", 5, 8) == "23456789"


def test_verdicts_and_prompts(spark):
    best = codes.verdict(F.col("p"), F.array(F.lit("a"), F.lit("b"), F.lit("c")))
    assert one(spark, best, "p array<double>", [0.2, 0.4, 0.4]).asDict() == {"label": "b", "score": 0.4}
    active = codes.active_prompt(F.col("p"))
    assert [one(spark, active, "p array<struct<version:string>>", [{"version": v} for v in vs]) for vs in (["1", "2"], ["1", "override"], [])] == [True, False, False]


def test_claims_that_need_a_check(spark):
    shape = "digest string, quote string, text string, entailment struct<label:string>"
    rows = [("a", "q", "t", {"label": "entails"}), ("a", " ", "t", None), ("b", "q", "t", {"label": "odd"}), ("c", "q", "t", None), ("c", "q", "t", {"label": "neutral"})]
    assert got(entail.needs_check(spark.createDataFrame(rows, shape), "digest"), "digest", "needs_check") == [("a", False), ("b", True), ("c", True)]


def test_first_values_and_numbers(spark):
    df = spark.createDataFrame([("k", 1, " "), ("k", 2, "b"), ("k", 3, "a"), ("m", 1, None)], "k string, n int, v string")
    assert got(dedup.first_value(df, ["k"], "v", ["n"]), "k", "v") == [("k", "b")]
    assert got(dedup.numbered(df, ["k"], ["n"]), "k", "n", "nth") == [("k", 1, 1), ("k", 2, 2), ("k", 3, 3), ("m", 1, 1)]


def test_digests_meet_records_configurations_and_memos(spark):
    d = spark.createDataFrame([("d1", "h1"), ("d2", "h9")], "digest string, hash string")
    assert got(digests.with_records(d, spark.createDataFrame([("h1", "t")], "hash string, title string")), "digest", "title", "binding") == [("d1", "t", "known"), ("d2", None, "unknown")]
    c = lambda *rows: spark.createDataFrame(rows, "fingerprint string, config string")
    assert got(digests.upsert_configs(c(("f", "x")), c(("f", "x"), ("g", "y"))), "fingerprint", "config") == [("f", "x"), ("g", "y")]
    with pytest.raises(ValueError, match="two configurations"):
        digests.upsert_configs(c(("f", "x")), c(("f", "y")))
    stored = spark.createDataFrame([("a", 1), ("old", 9)], "k string, v int")
    asked = spark.createDataFrame([("a",), ("b",)], "k string")
    assert got(digests.memo(["k"], asked, stored, lambda missing: missing.withColumn("v", F.length("k") + 6)), "k", "v") == [("a", 1), ("b", 7)]


def test_reports_of_claims_and_runs(spark):
    claims = spark.createDataFrame([("d", "c1", "t", "ch1:2-3", [("n1", "Ann", "subject"), ("n9", "Bob", None)]), ("d", "c2", "u", "char:1-2", None)], "digest_key string, claim_id string, text string, location string, refs array<struct<id:string,name:string,role:string>>")
    nodes = spark.createDataFrame([("d", "n1", "person")], "digest_key string, node_id string, node_type string")
    assert got(reports.flat_claims(claims, nodes), "claim_id", "ref", "role", "node_type") == [("c1", "Ann", "subject", "person"), ("c1", "Bob", None, None), ("c2", None, None, None)]
    assert got(reports.at_location(claims, "ch1:"), "claim_id") == [("c1",)]
    failed = spark.createDataFrame([("k", "date", "e1", False), ("k", "odd", "e2", False), ("k", "date", "e3", True)], "case_id string, dimension string, expectation_id string, passed boolean")
    assert got(reports.failed_expectations(failed, {"date": "the date is wrong"}), "expectation_id", "label") == [("e1", "the date is wrong"), ("e2", "odd")]
    m = lambda name, *rows: spark.createDataFrame(rows, f"model string, {name} int")
    assert got(reports.joined_metrics(m("a", ("x", 1)), m("b", ("x", 2), ("y", 3))), "model", "a", "b") == [("x", 1, 2), ("y", None, 3)]
    assert got(reports.union_of_names([nodes.withColumn("name", F.lit("A"))] * 2), "node_type", "name") == [("person", "A")]
    records = spark.createDataFrame([("r", "The light went out. Nobody spoke that night.")], "record_key string, body string")
    marks = spark.createDataFrame([("r", "u1", "light went out"), ("r", "u2", "that night"), ("r", "u3", "unheard")], "record_key string, unit_id string, text string")
    said = spark.createDataFrame([("d", "r", "The light went out"), ("d", "r", "gone"), ("e", "r", "spoke that")], "digest_key string, record_key string, quote string")
    assert got(reports.sweep_grade(records, marks, said), "digest_key", "located", "touched", "mean_chars") == [("d", 1, 1, 11.0), ("e", 1, 1, 10.0)]


def test_run_logs_in_the_order_of_calls(spark, tmp_path):
    (tmp_path / "m.txt").write_text("start\n nodes iter 1: +5 nodes\nnoise\n claims iter 1: +3 claims\n nodes iter 2: +2 nodes\nTRACE_JSON: [{\"cost_usd\": 0.5, \"input_tokens\": 10}, {\"cost_usd\": null}, {\"output_tokens\": 4}, {\"cost_usd\": 1}]\n")
    out = reports.run_progression(reports.run_log(reports.run_lines(spark, str(tmp_path))))
    assert got(out, "run", "loop", "stage", "fresh", "nodes", "claims", "items", "cum_cost", "input", "output") == [
        ("m.txt", 1, "nodes", 5, 5, 0, 5, 0.5, 10, 0), ("m.txt", 2, "claims", 3, 5, 3, 8, 0.5, 10, 0), ("m.txt", 3, "nodes", 2, 7, 3, 10, 0.5, 10, 4), ("m.txt", 4, None, 0, 7, 3, 10, 1.5, 10, 4),
    ]


def test_stages_from_their_digests(spark):
    golden = spark.createDataFrame([(1, "person", "Ann Lee", None), (2, "place", "Harbour", ["Port"])], "golden_id int, type string, canonical string, aliases array<string>")
    nodes = spark.createDataFrame([("m", "s1", "person", "a", "Ann Lee"), ("m", "s1", "person", "b", "Nobody"), ("m", "s2", "person", "a", "Ann Lee"), ("m", "s2", "place", "b", "Port")], "model string, stage string, type string, node_id string, name string")
    claims = spark.createDataFrame([("m", "s1", "It flew 30 feet up"), ("m", "s1", "It stood"), ("m", "s3", "x")], "model string, stage string, text string")
    out = reports.stage_trajectory(nodes, claims, golden)
    assert got(out, "stage", "nodes", "matched", "node_recall", "node_precision", "claims", "imperial") == [("s1", 2, 1, 0.5, 0.5, 2, 1), ("s2", 2, 2, 1.0, 1.0, None, None), ("s3", None, None, None, None, 1, 0)]


def test_health_of_records(spark):
    d = spark.createDataFrame([("a", 40_000, 80), ("b", 19_999, 5)], "k string, chars int, claims int")
    assert got(health.claim_yield(d), "k", "rate") == [("a", 2.0)]
    r = spark.createDataFrame([("a", "xx", "xxxxx"), ("b", "xxx", "xxxx"), ("c", "x", "")], "k string, materialised string, plain string")
    assert got(health.survival(r), "k", "survival", "over_marked") == [("a", 0.4, True), ("b", 0.75, False), ("c", None, None)]


def test_graphs_that_contradict(spark):
    p = lambda *rows: spark.createDataFrame(rows, "k string, before string, after string")
    assert got(graph.contradictions(p(("k", "a", "b"), ("k", "b", "c")), p(("k", "b", "a"), ("j", "c", "b")), ["k"]), "before", "after") == [("a", "b")]


def test_accounts_conform_and_overlap(spark):
    a = spark.createDataFrame([(None, " ", "here"), ("witness", "1990", None)], "teller_role string, when string, where string")
    assert got(accounts.conform(a), "teller_role", "when", "where") == [("unclear", None, "here"), ("witness", "1990", None)]
    s = lambda *rows: spark.createDataFrame(rows, "record_key string, account_id string, start int, end int")
    assert got(gold.account_ious(s(("r", "g", 0, 10), ("r", "g", 20, 30), ("r", "h", 90, 95)), s(("r", "p", 5, 10), ("r", "p", 20, 30))), "gold", "predicted", "score") == [("g", "p", 0.75)]


def test_reviews(spark):
    assert [one(spark, validation.review_state(F.col("h"), F.col("m")), "h boolean, m boolean", *x) for x in ((True, True), (False, True), (False, False))] == ["human", "machine", "none"]
    late = validation.carried_over(F.col("r"), F.lit("2024-01-02T00:00:00Z"))
    assert [one(spark, late, "r array<struct<at:string>>", [{"at": x}]) for x in ("2024-01-02T00:00:00Z", "2024-01-01T23:00:00Z", "2024-01-03T00:00:00", "2024-01-01T23:30:00-01:00")] == [True, False, False, True]
    d = spark.createDataFrame([("a", 4, "f", "h", "p"), ("b", 3, "f", "h", "q"), ("c", 4, "x", "y", "p")], "digest_key string, generation int, config string, record_hash string, pre_sha string")
    recs, confs = spark.createDataFrame([("h", "p")], "record_hash string, pre_sha string"), spark.createDataFrame([("f",)], "fingerprint string")
    assert got(validation.bound_outputs(d, recs, confs, 4), "key", "rule") == [("b", "generation"), ("b", "prepared"), ("c", "configuration"), ("c", "prepared"), ("c", "record")]


def test_readiness_of_a_corpus(spark):
    names = "corpus string, slot string, review_id string, basis string, rights string, controlled boolean, permitted boolean, manifest_hash string, record_hash string, record_rights string, reviewed boolean, coverage double, digestible boolean, digest_hash string, gold_units int, local string, hosted string"
    row = lambda slot, corpus="c", **x: tuple({**dict(corpus=corpus, slot=slot, review_id=f"v{slot}{corpus}", basis="public_domain", rights="public_domain", controlled=None, permitted=None, manifest_hash="h", record_hash="h", record_rights="public_domain", reviewed=True, coverage=1.0, digestible=True, digest_hash="h", gold_units=3, local="ready", hosted="ready"), **x}.values())  # noqa: E731, C408
    rows = [
        row("open"), row("local", basis="local_information_analysis", rights="publicly_accessible", record_rights="publicly_accessible", controlled=True, hosted="blocked"), row("bare", gold_units=None, local="blocked", hosted="blocked"),
        row("closed", basis="open_licence", rights="open_licence", record_rights="open_licence", local="blocked"), row("given", "d", basis="internal_evaluation_permission", rights="restricted", record_rights="restricted", permitted=True),
    ]
    items = spark.createDataFrame(rows, names)
    bases = ["public_domain", "open_licence", "internal_evaluation_permission", "local_information_analysis"]
    assert validation.item_problems(items, bases).collect() == []
    states = validation.item_states(items)
    assert got(states, "slot", "status", "gold", "local", "hosted", "decision") == [
        ("bare", "blocked", "unavailable", "blocked", "blocked", "await-reference-highlights"), ("closed", "blocked", "human-reviewed", "blocked", "ready", "resolve-local-rights"), ("given", "reviewed", "human-reviewed", "ready", "ready", "admitted-local-evaluation"),
        ("local", "reviewed", "human-reviewed", "ready", "blocked", "admitted-local-evaluation"), ("open", "reviewed", "human-reviewed", "ready", "ready", "admitted-local-evaluation"),
    ]
    assert got(validation.corpus_state(states), "corpus", "status", "gold", "units", "local_ready", "hosted_ready", "decision") == [("c", "blocked", "unavailable", 9, 2, 2, "resolve-evaluation-blockers"), ("d", "reviewed", "human-reviewed", 3, 1, 1, "admitted-local-evaluation")]
    alone = validation.corpus_state(states.where("slot in ('open', 'bare')")).first()
    assert (alone.status, alone.decision) == ("blocked", "await-reference-highlights")
    bad = [row("x", basis="odd", local="ready"), row("x", record_hash="g", record_rights=None, digest_hash=None, coverage=0.9, review_id=None, hosted="blocked")]
    rules = [r[1] for r in got(validation.item_problems(spark.createDataFrame(bad, names), bases), "slot", "rule")]
    assert sorted(rules) == sorted(["no admitted rights basis", "local readiness contradicts its evidence", "record differs from the manifest", "rights differ from the record", "digest of another record", "source review is not complete", "no review id", "hosted readiness contradicts its evidence", "slot repeats"])
