import pytest
from pyspark.sql import functions as F

from folioscope.operators import reports
from folioscope.sources import records, registry


def test_reports(spark):
    nodes = spark.createDataFrame([("d", "n1", "person", "Ann"), ("d", "n2", "gadget", "X")], "digest_key string, node_id string, node_type string, name string")
    assert [r.digest_key for r in reports.dirty_digests(nodes).collect()] == ["d"]
    assert [(r.node_type, r.n) for r in reports.dead_types(nodes).collect()] == [("gadget", 1)]
    assert {r.node_type: r.names for r in reports.found_by_type(nodes).collect()} == {"person": ["Ann"], "gadget": ["X"]}
    claims = spark.createDataFrame([("c", "r", "00:00:01.250"), ("e", "r", "char:1-2")], "claim_id string, record_key string, location string")
    assert {r.claim_id: r.position_ms for r in reports.materialised_claims(claims).collect()} == {"c": 1250, "e": None}
    log = spark.createDataFrame([("  nodes iter 2: +7 nodes (cached)",), ('TRACE_JSON: [{"pass": "nodes", "cost": 0.5}, {"pass": "claims"}]',), ('USAGE_JSON: {"model": "m", "calls": 3, "cost": 0.5}',), ("noise",)], "value string")
    got = reports.run_log(log).collect()
    assert len(got) == 3 and (got[0].stage, got[0].round, got[0].fresh) == ("nodes", 2, 7) and len(got[1].trace) == 2 and got[2].usage["calls"] == "3"
    deltas = spark.createDataFrame([(0.01,), (1.0,), (30.0,), (None,)], "delta double")
    assert abs(reports.delta_buckets(deltas).first().exact - 1 / 3) < 1e-9
    side = spark.createDataFrame([("r1", 0.9, "h"), ("r2", 0.95, "old")], "record_key string, observed_coverage double, reviewed_body_sha256 string")
    recs = spark.createDataFrame([("r1", "h"), ("r2", "new"), ("r3", "x")], "record_key string, pre_sha string")
    assert [(r.record_key, r.digestible) for r in reports.coverage_listing(recs, side, 0.8).collect()] == [("r2", False), ("r1", True), ("r3", False)]


def test_registry(spark, tmp_path):
    (tmp_path / "registry.yaml").write_text("nodes: {active: 3, file: n.txt}")
    (tmp_path / "n.txt").write_text("hello")
    assert registry.active_prompts(str(tmp_path), {})["nodes"]["version"] == "3"
    assert registry.active_prompts(str(tmp_path), {"PROMPT_FILE_NODES": str(tmp_path / "n.txt")})["nodes"]["version"] == "override"
    assert registry.generation(str(tmp_path), 4) == 4
    with pytest.raises(ValueError):
        registry.generation(str(tmp_path), 5)
    name, text = registry.synthetic_record("T", "Body text", source_type="web")
    assert len(name) == 67 and records.parse(text)["body"] == "Body text"
    (tmp_path / "recs").mkdir()
    (tmp_path / "recs" / name).write_text(text)
    assert records.prepared(records.scan(spark, str(tmp_path / "recs"))).select("title", F.length("pre_sha").alias("n")).first().asDict() == {"title": "T", "n": 64}
