"""The stop rule as a stream, digests as variants, chunks as a table function."""

import json
import random

from pyspark.sql import functions as F

from folioscope.operators import chunks, dedup
from folioscope.plans import catalogue
from folioscope.session import table
from folioscope.sources import digests
from folioscope.streaming import ingest, stopping


def replayed(spark, rounds):
    flat = rounds.select("record_key", "chunk", "round", F.inline("items"), "complete")
    return sorted((r.record_key, r.chunk, r.round, r.pos, r.identity) for r in dedup.replay_rounds(flat).where("identity is not null").collect())


def test_the_stream_keeps_what_the_replay_keeps(spark, tmp_path):
    """In two runs with a stop between, from one checkpoint."""
    rng = random.Random(1)
    rows = [(f"r{k}", c, n, [{"pos": p, "identity": f"i{rng.randint(0, 25)}"} for p in range(rng.randint(1, 5))], rng.random() < 0.1) for k in range(5) for c in range(3) for n in range(8)]
    rows += [("r0", 9, 0, [{"pos": 0, "identity": None}], False), ("r0", 9, 1, None, False)]
    df = spark.createDataFrame(rows, stopping.ROUND)
    where = {n: str(tmp_path / n) for n in ("in", "out", "checkpoint")}
    for half in (F.col("chunk") < 1, F.col("chunk") >= 1):
        df.where(half).coalesce(1).write.mode("append").parquet(where["in"])
        kept = stopping.kept_items(ingest.watch(spark, where["in"], df.schema))
        ingest.run_available(kept, where["out"], where["checkpoint"])
    got = sorted(tuple(r) for r in spark.read.schema(stopping.KEPT).parquet(where["out"]).collect())
    assert got == replayed(spark, df) and len(got) > 30


def test_the_registered_stream_equals_the_replay(spark, small):
    got = sorted(tuple(r) for r in catalogue.QUERIES["q79_stop_rule_stream"](spark, small).collect())
    assert got == replayed(spark, stopping.rounds_of(table(spark, small, "events"))) and len(got) > 100


def test_sessions_and_windows_in_batch_form(spark):
    e = spark.createDataFrame([("u", "2024-01-01 00:00:00"), ("u", "2024-01-01 00:10:00"), ("u", "2024-01-01 02:00:00")], "k string, ts string").withColumn("ts", F.to_timestamp("ts"))
    assert sorted(r.n for r in ingest.sessions(e, "ts", "k").collect()) == [1, 2] and sorted(r.n for r in ingest.windows(e, "ts", ["k"]).collect()) == [1, 2]


def test_variants_are_read_by_typed_paths(spark):
    docs = [{"ai_usage": [{"tokens": {"cache_read": 5, "cache_write": 2, "calls": 7, "other": "x"}}, {"tokens": {"calls": 1}}], "nodes": [{"id": "n", "type": "person", "name": "Ann", "metadata": {"a": 1}}]}, {"claims": [{"id": "c", "date": 1999, "refs": None}]}]
    d = digests.load(spark.createDataFrame([("a", json.dumps(docs[0])), ("b", json.dumps(docs[1])), ("bad", "x: ["), ("list", "- 1"), ("none", None)], "digest_key string, value string"))
    assert dict(d.dtypes)["doc"] == "variant"
    assert {(r.digest_key, r.issue) for r in d.select("digest_key", "issue").collect() if r.issue} == {("bad", "malformed_yaml"), ("list", "invalid_document"), ("none", "unreadable")}
    assert {(r.digest_key, r.calls, r.reads, r.writes) for r in digests.usage(d).collect()} == {("a", 7, 5, 2), ("b", None, None, None)}
    assert [(r.claim_id, r.date, r.refs) for r in digests.claims(d).collect()] == [("c", "1999", [])] and [r.name for r in digests.nodes(d).collect()] == ["Ann"]
    rows = spark.createDataFrame([("x", '{"k": 1, "s": "t"}'), ("x", '{"k": 2}'), ("y", "{"), ("y", None)], "g string, props string")
    assert {tuple(r) for r in digests.values_by_path(rows, "props", ["g"]).collect()} == {("x", "$.k", "BIGINT", 2), ("x", "$.s", "STRING", 1), ("y", "$", "malformed", 1)}


def test_the_table_function_cuts_as_the_map_does(spark, small):
    docs = table(spark, small, "documents").select("doc_id", "text").unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "a\n<!-- chapter: x -->\nb\n<!-- chapter: y -->\nc" * 3)], "doc_id long, text string"))
    for most, least in ((700, 200), (20_000, None)):
        assert sorted(chunks.chunked(docs, "doc_id", "text", most, least).collect()) == sorted(chunks.chunk_rows(docs, "doc_id", "text", most, least).collect())
    got = catalogue.QUERIES["q12_chunk_documents"](spark, small)
    assert got.columns == ["doc_id", "idx", "start", "end", "sha"]
