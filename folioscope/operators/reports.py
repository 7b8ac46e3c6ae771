"""Smaller filters, projections and report tables over digests and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lint
from ..functions.codes import milliseconds, parse_timecode
from ..schemas import NODE_TYPES
from .evaluation import matched_nodes
from .grade import located
from .sweep import both_ends


def dirty_digests(nodes: DataFrame) -> DataFrame:
    """Digests that hold a node of a deprecated type."""
    return nodes.where(~F.col("node_type").isin(*NODE_TYPES)).select("digest_key").distinct()


def dead_types(nodes: DataFrame) -> DataFrame:
    return nodes.where(~F.col("node_type").isin(*NODE_TYPES)).groupBy("node_type").agg(F.count(F.lit(1)).alias("n"))


def at_location(claims: DataFrame, prefix: str) -> DataFrame:
    return claims.where(F.col("location").startswith(prefix))


def found_by_type(nodes: DataFrame) -> DataFrame:
    """(digest_key, node_type, names), the names in order."""
    return nodes.groupBy("digest_key", "node_type").agg(F.array_sort(F.collect_set("name")).alias("names"))


def union_of_names(runs: list[DataFrame]) -> DataFrame:
    """Unique (node_type, name) over discovery strategies."""
    out = runs[0].select("node_type", "name")
    for r in runs[1:]:
        out = out.unionByName(r.select("node_type", "name"))
    return out.distinct()


def materialised_claims(claims: DataFrame) -> DataFrame:
    """(claim_id, record_key, position_ms): exact, null where the location is no time. Check with :func:`claim_id_violations` first."""
    seconds = F.regexp_extract("location", "^([0-9:.]+)", 1)
    return claims.select("claim_id", "record_key", milliseconds(parse_timecode(seconds).cast("decimal(18,3)").cast("string")).alias("position_ms"))


def claim_id_violations(claims: DataFrame) -> DataFrame:
    """(key, rule) of claims without an id, or with one that another claim of their record has."""
    from .validation import unique_ids, violations

    return violations(claims, "record_key", claim_id=F.trim("claim_id") != "").unionByName(unique_ids(claims.where("claim_id is not null"), ["record_key", "claim_id"]))


def category_counts(claims: DataFrame) -> DataFrame:
    """(digest_key, domain, infrastructure)."""
    return claims.groupBy("digest_key").agg(F.count_if(F.col("category") == "domain").alias("domain"), F.count_if(F.col("category") == "infrastructure").alias("infrastructure"))


def flat_claims(claims: DataFrame, nodes: DataFrame) -> DataFrame:
    """A row for each reference, with its node's type."""
    refs = claims.select("digest_key", "claim_id", "text", "location", F.explode_outer("refs").alias("r"))
    kinds = nodes.select("digest_key", F.col("node_id").alias("ref_id"), "node_type")
    return refs.select("digest_key", "claim_id", "text", "location", F.col("r.id").alias("ref_id"), F.col("r.name").alias("ref"), F.col("r.role").alias("role")).join(kinds, ["digest_key", "ref_id"], "left")


def sweep_grade(records: DataFrame, highlights: DataFrame, claims: DataFrame) -> DataFrame:
    """Per run: highlights touched (closed intervals), quotes located, mean length, share of compound claims."""
    hits = located(claims, records).withColumn("ok", F.col("start") >= 0)
    spans = located(highlights, records, "text").where("start >= 0").select("record_key", "unit_id", F.col("start").alias("g0"), F.col("end").alias("g1"))
    touched = hits.where("ok").join(spans, "record_key").where("not (end < g0 or start > g1)").groupBy("digest_key").agg(F.countDistinct("unit_id").alias("touched"))
    out = hits.groupBy("digest_key").agg(F.count_if("ok").alias("located"), F.avg(F.length("quote")).alias("mean_chars"), F.avg(lint.two_assertions(F.col("text" if "text" in hits.columns else "quote")).cast("double")).alias("compound"))
    return out.join(touched, "digest_key", "left").na.fill(0, ["touched"])


def overlap_fractions(claims: DataFrame, highlights: DataFrame, most: float = 0.8) -> DataFrame:
    """Per claim the share of it inside highlights, summed part by part: it may exceed 1 where highlights overlap. Repeated rows count once."""
    found = both_ends(claims, highlights, ["record_key"], ["claim_id"])
    share = F.try_divide(F.sum("length"), (F.max("end") - F.max("start")).cast("double"))
    return found.groupBy("record_key", "claim_id").agg(F.coalesce(share, F.lit(0.0)).alias("inside")).withColumn("on_target", F.col("inside") >= most)


def workbench_grade(claims: DataFrame, highlights: DataFrame, least: float = 0.5, most: float = 0.8) -> DataFrame:
    """(record_key, highlights, covered, coverage, claims, unmarked, unlocated): highlights of which claims cover ``least``, and claims less than ``most`` inside highlights.

    Overlaps are summed part by part, on both sides, so they may exceed 1. Claims without a place (null start) count as unlocated and unmarked.
    """
    placed = claims.where("start is not null")
    # highlights that repeat a place count each, at the share of one
    marks = both_ends(highlights, placed.select("record_key", "start", "end"), ["record_key"], [])
    share = F.col("length") / F.greatest(F.lit(1), F.col("end") - F.col("start"))
    shares = highlights.join(marks.withColumn("share", share).select("record_key", "start", "end", "share"), ["record_key", "start", "end"], "left")
    covered = shares.groupBy("record_key").agg(F.count(F.lit(1)).alias("highlights"), F.count_if(F.col("share") >= least).alias("covered"))
    inside = overlap_fractions(placed, highlights, most).groupBy("record_key").agg(F.count_if(~F.col("on_target")).alias("_off"))
    total = claims.groupBy("record_key").agg(F.count(F.lit(1)).alias("claims"), F.count_if(F.col("start").isNull()).alias("unlocated"))
    out = covered.join(total, "record_key", "full").join(inside, "record_key", "left").na.fill(0, ["highlights", "covered", "claims", "unlocated", "_off"])
    return out.select("record_key", "highlights", "covered", F.try_divide(F.col("covered").cast("double"), F.col("highlights")).alias("coverage"), "claims", (F.col("_off") + F.col("unlocated")).alias("unmarked"), "unlocated")


def nodes_by_type(nodes: DataFrame) -> DataFrame:
    """(digest_key, node_type, n, nodes): a digest's nodes grouped, in order of name."""
    return nodes.groupBy("digest_key", "node_type").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("name", "node_id"))).alias("nodes"))


def coverage_listing(records: DataFrame, sidecars: DataFrame, threshold: float) -> DataFrame:
    """Observed coverage, best first, and whether a record may be digested; a record without a sidecar may not."""
    from .validation import digestible

    out = records.join(sidecars, "record_key", "left")
    return out.withColumn("digestible", digestible(F.col("observed_coverage"), threshold, F.col("pre_sha"), F.col("reviewed_body_sha256"))).orderBy(F.desc_nulls_last("observed_coverage"), "record_key")


def delta_buckets(deltas: DataFrame, delta: str = "delta") -> DataFrame:
    """Shares of alignment differences by size; of ambiguous and of well covered ones too, where the rows say."""
    d, n = F.abs(F.col(delta)), F.count(delta)
    share = lambda c, over=n: F.try_divide(F.count_if(c).cast("double"), over)
    more = [share(F.col("state") == "ambiguous", F.count(F.lit(1))).alias("ambiguous")] if "state" in deltas.columns else []
    if "coverage" in deltas.columns:
        more += [share(F.col("coverage") >= least, F.count(F.lit(1))).alias(f"covered_{int(least * 100)}") for least in (0.99, 0.9, 0.5)]
    return deltas.agg(share(d < 0.05).alias("exact"), share(d <= 2).alias("within_2"), share(d <= 5).alias("within_5"), share(d <= 10).alias("within_10"), share(d > 10).alias("beyond"), *more)


def worst_deltas(deltas: DataFrame, delta: str = "delta", most: int = 12) -> DataFrame:
    """The largest differences; the limit is the feature."""
    return deltas.where(F.col(delta).isNotNull()).orderBy(F.desc(F.abs(F.col(delta))), *[c for c in deltas.columns if c != delta][:1]).limit(most)


def failed_expectations(rows: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Failing expectations in plain words."""
    words = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return rows.where(~F.col("passed")).select("case_id", "dimension", "expectation_id", F.coalesce(F.try_element_at(words, F.col("dimension")), F.col("dimension")).alias("label"))


def joined_metrics(base: DataFrame, *others: DataFrame) -> DataFrame:
    """One row a model, whatever is missing."""
    out = base
    for o in others:
        out = out.join(o, "model", "full")
    return out


def stage_trajectory(nodes: DataFrame, claims: DataFrame, golden: DataFrame) -> DataFrame:
    """Per model and stage of its development: claims, node recall and precision against the golden names, and lint flags, all from the digests' rows.

    ``nodes`` has (model, stage, type, node_id, name), ``claims`` (model, stage, text), ``golden`` (golden_id, type, canonical, aliases) and its must-find names alone.
    """
    ids = nodes.select("type", F.struct("model", "stage", "node_id").alias("ext_id"), "name")
    found = matched_nodes(ids, golden).select("ext_id.model", "ext_id.stage", "golden_id")
    must = golden.agg(F.countDistinct("golden_id").alias("must_find"))
    rate = lambda part, over: F.bround(F.try_divide(F.col(part).cast("double"), F.col(over)), 3)
    hits = found.groupBy("model", "stage").agg(F.count(F.lit(1)).alias("nodes"), F.countDistinct("golden_id").alias("matched"), F.count("golden_id").alias("_known")).crossJoin(F.broadcast(must))  # one row
    hits = hits.select("model", "stage", "nodes", "matched", rate("matched", "must_find").alias("node_recall"), rate("_known", "nodes").alias("node_precision"))
    said = claims.groupBy("model", "stage").agg(F.count(F.lit(1)).alias("claims"), *(F.count_if(c).alias(n) for n, c in lint.flags(F.col("text")).items()))
    return hits.join(said, ["model", "stage"], "full")


def run_lines(spark: SparkSession, path: str) -> DataFrame:
    """(run, line, value) of a folder's run outputs: each file's name and its lines in order."""
    files = spark.read.text(path, wholetext=True).withColumn("run", F.regexp_extract(F.input_file_name(), "([^/]+)$", 1))
    return files.select("run", F.posexplode(F.split("value", "\r?\n")).alias("line", "value"))


def run_log(lines: DataFrame) -> DataFrame:
    """Rounds, traces and usage from a run's output lines: (stage, round, fresh), or a trace's steps, or usage; with the run and the line where the lines have them."""
    pattern = "(nodes|claims) iter ([0-9]+): [+]([0-9]+) (?:nodes|claims)"
    get = lambda p, i: F.nullif(F.regexp_extract("value", p, i), F.lit(""))
    trace = F.from_json(get("TRACE_JSON: (\\[.*\\])", 1), "array<map<string,string>>")
    usage = F.from_json(get("USAGE_JSON: *(\\{.*\\})", 1), "map<string,string>")
    place = [c for c in ("run", "line") if c in lines.columns]
    out = lines.select(*place, get(pattern, 1).alias("stage"), get(pattern, 2).try_cast("int").alias("round"), get(pattern, 3).try_cast("int").alias("fresh"), trace.alias("trace"), usage.alias("usage"))
    return out.where("stage is not null or trace is not null or usage is not null")


def run_progression(log: DataFrame) -> DataFrame:
    """(run, loop, stage, fresh, nodes, claims, items, cost, cum_cost, input, output) in the order of calls: what each round brought, and running totals.

    The n-th round of a run goes with the n-th step of its trace, the last trace that it wrote; either may be longer. Counts that a step lacks are 0.
    """
    order = Window.partitionBy("run").orderBy("line")
    rounds = log.where("stage is not null").select("run", F.row_number().over(order).alias("loop"), "stage", "fresh")
    last = log.where("trace is not null").groupBy("run").agg(F.max_by("trace", "line").alias("trace"))
    number = lambda c, kind: F.coalesce(F.try_element_at("step", F.lit(c)).try_cast(kind), F.lit(0).cast(kind))
    steps = last.select("run", F.posexplode("trace").alias("at", "step")).select("run", (F.col("at") + 1).alias("loop"), number("cost_usd", "double").alias("cost"), number("input_tokens", "long").alias("_in"), number("output_tokens", "long").alias("_out"))
    both = rounds.join(steps, ["run", "loop"], "full").na.fill(0, ["fresh", "cost", "_in", "_out"])
    upto = Window.partitionBy("run").orderBy("loop").rowsBetween(Window.unboundedPreceding, 0)
    of = lambda stage: F.sum(F.when(F.col("stage") == stage, F.col("fresh")).otherwise(0)).over(upto)
    out = both.select("run", "loop", "stage", "fresh", of("nodes").alias("nodes"), of("claims").alias("claims"), "cost", F.round(F.sum("cost").over(upto), 6).alias("cum_cost"), F.sum("_in").over(upto).alias("input"), F.sum("_out").over(upto).alias("output"))
    return out.withColumn("items", F.col("nodes") + F.col("claims"))
