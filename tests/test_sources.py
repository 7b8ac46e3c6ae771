import json

from pyspark.sql import functions as F

from folioscope.sources import digests, records
from folioscope.streaming import ingest

RECORD = """---
schema: record/1
title: A talk
date_published: 2021-05-17T00:00:00
creators: [Ann, Bo]
source_type: video
length: 12
---
First line.
---
file_page: 3
---
Second {{highlight-start: h1}}line{{highlight-end: h1}} here {{highlight-start: h2}}open.
{{highlight-context: [h2, h1]}}
<!-- speaker: Cy -->
00:00:01.0 Hello there
---
just a rule, not a mapping
---
"""


def frame(spark):
    return spark.createDataFrame([("k", RECORD), ("bare", "no front matter"), ("nil", None)], "record_key string, value string")


def test_parse(spark):
    rows = {r.record_key: r for r in records.read_records(frame(spark)).collect()}
    r = rows["k"]
    assert (r.title, r.date, r.creators, r.source_type) == ("A talk", "2021-05-17", ["Ann", "Bo"], "video")
    assert json.loads(r.metadata["length"]) == 12
    assert [(p.file_page, p.offset) for p in r.pages] == [(3, len("First line.\n"))]
    assert "file_page" not in r.body and "just a rule" in r.body
    assert rows["bare"].body == "no front matter" and rows["nil"].body == ""


def test_highlights_and_context(spark):
    recs = records.read_records(frame(spark))
    got = {r.id: r.text for r in records.highlights(recs).collect()}
    assert got["h1"] == "line" and got["h2"].startswith("open.")
    assert [(r.dependent, r.ancestor) for r in records.context_edges(recs).collect()] == [("h2", "h1")]
    assert [(r.speaker, r.at, r.text) for r in records.transcript(recs).collect()] == [("Cy", 1.0, "Hello there")]


def test_materialise_is_idempotent(spark):
    df = spark.createDataFrame([("a {{t:1.0}}b<!-- irrelevant: start -->x<!-- irrelevant: end --> c<!-- image: y -->",)], "body string")
    once = df.select(records.materialise(F.col("body")).alias("body"))
    assert once.first().body == "a b c"
    assert once.select(records.materialise(F.col("body")).alias("b")).first().b == "a b c"


DIGEST = """
nodes: [{id: n1, type: person, name: Ann}, {id: n2, type: gadget, name: X}]
domain_claims: [{id: c1, text: T, quote: Q, refs: [{id: n1, name: Ann, role: subject}]}]
infrastructure_claims: [{id: c2, content: U, original_excerpt: " ", type: opinion}]
"""


def test_digests(spark):
    texts = spark.createDataFrame([("d", DIGEST), ("bad", "a: ["), ("list", "[1]"), ("nil", None)], "digest_key string, value string")
    d = digests.load(texts)
    assert {r.digest_key: r.issue for r in d.collect()} == {"d": None, "bad": "malformed_yaml", "list": "invalid_document", "nil": "unreadable"}
    c = {r.claim_id: r for r in digests.claims(d).collect()}
    assert c["c1"].category == "domain" and c["c1"].type == "administrative" and c["c1"].refs[0].role == "subject"
    assert c["c2"].category == "infrastructure" and c["c2"].quote is None and c["c2"].text == "U"
    assert [r.name for r in digests.nodes(d).collect()] == ["Ann"]


def test_resolve_and_refresh(spark):
    t = lambda rows: spark.createDataFrame(rows, "hash string, record string")
    got = {r.hash: r.record for r in digests.resolve(t([("h1", "declared")]), t([("h1", "stem"), ("h2", "stem2")]), t([("h2", "old"), ("h3", "old3")])).collect()}
    assert got == {"h1": "declared", "h2": "stem2", "h3": "old3"}
    cur = spark.createDataFrame([("r", "A", 1)], "record string, title string, n int")
    new = spark.createDataFrame([("r", "B", 1)], "record string, title string, n int")
    plan = digests.refresh_plan(cur, new, ["title", "n"])
    assert [(r.field, r.old, r.new) for r in plan.collect()] == [("title", "A", "B")]
    assert digests.refresh_apply(cur, plan, ["title", "n"]).first().title == "B"


def test_variants(spark, tmp_path):
    schema = "record string, model string, prompt_sha8 string, run_label string, variant_only boolean, extracted_at string, passes array<struct<version:string>>, body string"
    rows = [("r", "m", "0123abcd", "", False, "2", [("v1",)], "x"), ("r", "m", "0123abcd", "trial", False, "3", [("v1",)], "y"), ("r", "m", "ffffffff", "", False, "4", [("override",)], "z")]
    df = spark.createDataFrame(rows, schema)
    digests.write_variants(df, str(tmp_path / "v"))
    digests.write_variants(df.limit(1).withColumn("body", F.lit("new")), str(tmp_path / "v"))
    back = {(r.prompt_sha8, r.run_label or ""): r.body for r in spark.read.parquet(str(tmp_path / "v")).collect()}
    assert len(back) == 3 and "new" in back.values()
    assert [r.body for r in digests.production(df).collect()] == ["x"]
    assert digests.fingerprint({"b": 1, "a": 2}) == digests.fingerprint({"a": 2, "b": 1})


def test_streaming(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id) as ts, id % 5 as k from range(50)").write.parquet(str(src))
    stream = ingest.watch(spark, str(src), spark.read.parquet(str(src)).schema)
    ingest.run_available(ingest.first_claims(stream, ["k"], "ts"), str(out), str(tmp_path / "ck"))
    assert sorted(r.k for r in spark.read.parquet(str(out)).collect()) == [0, 1, 2, 3, 4]
    ingest.run_available(ingest.first_claims(stream, ["k"], "ts"), str(out), str(tmp_path / "ck"))
    assert spark.read.parquet(str(out)).count() == 5
