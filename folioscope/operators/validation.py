"""Rule engines as violation queries: each gives (key, rule) rows, and no row means valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import DECISIONS, OPEN_RIGHTS


def violations(rows: DataFrame, key: str, **rules: Column) -> DataFrame:
    """One row for each rule (a condition that must hold) that a row breaks; unknown counts as broken."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items())))
    return rows.select(F.col(key).cast("string").alias("key"), F.explode(broken).alias("rule"))


def require(found: DataFrame) -> None:
    """Fail closed."""
    first = found.limit(5).collect()
    if first:
        raise ValueError("; ".join(f"{r['key']}: {r['rule']}" for r in first))


def gold_units(units: DataFrame) -> DataFrame:
    """Spans in order, inside the text, of known decisions, with facts exactly where a unit is split, and no two overlapping."""
    found = violations(
        units, "unit_id", span=(F.col("start") >= 0) & (F.col("end") > F.col("start")) & (F.col("end") <= F.col("n_chars")), decision=F.col("decision").isin(*DECISIONS), facts=(F.col("decision") == "split") == (F.size(F.coalesce("facts", F.array())) > 0)
    )
    w = Window.partitionBy("record_key").orderBy("start", "end")
    overlap = units.withColumn("_p", F.lag("end").over(w)).where("_p > start").select(F.col("unit_id").cast("string").alias("key"), F.lit("overlap").alias("rule"))
    return found.unionByName(overlap)


def unique_ids(rows: DataFrame, keys: list[str]) -> DataFrame:
    n = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return n.select(F.concat_ws("/", *keys).alias("key"), F.lit("duplicate id").alias("rule"))


def references(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Values without a row to refer to."""
    missing = child.join(parent.select(column).distinct(), column, "left_anti")
    return missing.select(F.col(column).cast("string").alias("key"), F.lit(f"unknown {column}").alias("rule"))


def reviewer(name: Column, stamp: Column) -> Column:
    """A name, and a timestamp with a time zone."""
    zoned = stamp.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:.]+(?:Z|[+-][0-9]{2}:[0-9]{2})$")
    return (F.trim(name) != "") & zoned & F.try_to_timestamp(stamp).isNotNull()


def review_state(by_human: Column, by_machine: Column) -> Column:
    return F.when(by_human, "human").when(by_machine, "machine").otherwise("none")


def carried_over(reviews: Column, marker: Column) -> Column:
    """A review at or after the marker; both must have a time zone."""
    zoned = lambda c: c.rlike("(?:Z|[+-][0-9]{2}:[0-9]{2})$")
    return zoned(marker) & F.exists(reviews, lambda r: zoned(r["at"]) & (F.try_to_timestamp(r["at"]) >= F.try_to_timestamp(marker)))


def digestible(observed: Column, threshold: float, body_sha: Column, reviewed_sha: Column) -> Column:
    """Covered enough, and reviewed on exactly this body; no sidecar, no."""
    return F.coalesce((observed >= threshold) & (body_sha == reviewed_sha), F.lit(False))


def bound_outputs(digests: DataFrame, records: DataFrame, configs: DataFrame, generation: int) -> DataFrame:
    """A digest's generation, configuration, record hash and prepared-text hash all hold."""
    d = digests.join(records.select("record_hash", F.lit(True).alias("_record"), F.col("pre_sha").alias("_pre")), "record_hash", "left").join(configs.select(F.col("fingerprint").alias("config"), F.lit(True).alias("_config")), "config", "left")
    return violations(d, "digest_key", generation=F.col("generation") == generation, configuration=F.col("_config"), record=F.col("_record"), prepared=F.col("pre_sha") == F.col("_pre"))


def proposals(rows: DataFrame) -> DataFrame:
    """Review proposals once for each normal text: the first by order, and every model that made it."""
    from ..functions.text import collapsed, lowered

    keyed = rows.withColumn("_k", collapsed(lowered(F.col("text"))))
    return keyed.groupBy("record_key", "_k").agg(F.min_by("text", "ord").alias("text"), F.array_sort(F.collect_set("model")).alias("models")).drop("_k")


def rollup_status(items: DataFrame, key: str) -> DataFrame:
    """The status of a corpus: ready only if all its items are, with a hash over their evidence in order."""
    return items.groupBy(key).agg(F.when(F.bool_and(F.col("status") == "ready"), "ready").otherwise("blocked").alias("status"), F.sum("units").alias("units"), F.sha2(F.array_join(F.array_sort(F.collect_list("evidence")), "\n"), 256).alias("evidence"))


# Rights bases, and the codes of what is decided about a record and a corpus.
LOCAL_BASIS, PERMITTED = "local_information_analysis", ("open_licence", "internal_evaluation_permission")
ADMITTED, AWAITED, LOCAL_RIGHTS, BLOCKERS = "admitted-local-evaluation", "await-reference-highlights", "resolve-local-rights", "resolve-evaluation-blockers"


def item_problems(items: DataFrame, bases: list[str]) -> DataFrame:
    """(slot, rule) of manifest entries that contradict their evidence; the readiness of such a corpus is not to be believed.

    ``items`` has (corpus, slot, review_id, basis, rights, controlled, permitted, manifest_hash, record_hash, record_rights, reviewed, coverage, digestible, digest_hash, gold_units, local, hosted).
    """
    local, hosted = _ready(F.lit(True))
    said = lambda c, ready: F.col(c).eqNullSafe(F.when(ready, "ready").otherwise("blocked"))
    rules = {
        "no admitted rights basis": F.col("basis").isin(*bases), "record differs from the manifest": F.col("record_hash") == F.col("manifest_hash"), "rights differ from the record": F.col("record_rights").eqNullSafe(F.col("rights")),
        "source review is not complete": F.col("reviewed") & (F.col("coverage") == 1.0) & F.col("digestible"), "digest of another record": F.col("digest_hash") == F.col("manifest_hash"),
        "local readiness contradicts its evidence": said("local", local), "hosted readiness contradicts its evidence": said("hosted", hosted), "no slot": F.trim("slot") != "", "no review id": F.trim("review_id") != "",
    }
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(rule)) for rule, ok in rules.items()]))
    twice = lambda c: items.where(F.col(c).isNotNull()).groupBy("corpus", c).agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("_slot")).where("n > 1")
    return items.select("slot", F.explode(broken).alias("rule")).unionByName(twice("slot").select(F.col("_slot").alias("slot"), F.lit("slot repeats").alias("rule"))).unionByName(twice("review_id").select(F.col("_slot").alias("slot"), F.lit("review id repeats").alias("rule")))


def _ready(reviewed: Column) -> tuple[Column, Column]:
    """Whether an item is ready for local and for hosted use: reviewed, with gold, and with rights for it."""
    basis, permitted = F.col("basis"), F.coalesce("permitted", F.lit(False))
    controlled = (basis == LOCAL_BASIS) & (F.col("rights") == "publicly_accessible") & F.coalesce("controlled", F.lit(False))
    local = (basis == "public_domain") | controlled | (basis.isin(*PERMITTED) & permitted)
    hosted = F.col("rights").isin("public_domain", "open_licence") | ((basis == PERMITTED[1]) & permitted)
    gold = reviewed & (F.coalesce("gold_units", F.lit(0)) > 0)
    return gold & F.coalesce(local, F.lit(False)), gold & F.coalesce(hosted, F.lit(False))


def item_states(items: DataFrame) -> DataFrame:
    """Per item: status (reviewed or blocked), gold (human-reviewed or unavailable), readiness, and what is decided about it; missing gold comes before missing rights."""
    whole = F.coalesce(F.col("reviewed") & (F.col("coverage") == 1.0) & F.col("digestible"), F.lit(False))
    local, hosted = _ready(whole)
    gold = F.coalesce("gold_units", F.lit(0)) > 0
    word = lambda ready: F.when(ready, "ready").otherwise("blocked")
    return items.select(
        "corpus", "slot", F.when(local, "reviewed").otherwise("blocked").alias("status"), F.when(gold, "human-reviewed").otherwise("unavailable").alias("gold"), F.coalesce("gold_units", F.lit(0)).cast("long").alias("units"),
        word(local).alias("local"), word(hosted).alias("hosted"), F.when(~gold, AWAITED).when(~local, LOCAL_RIGHTS).otherwise(ADMITTED).alias("decision"), F.col("digest_hash").alias("evidence"),
    )


def corpus_state(states: DataFrame) -> DataFrame:
    """The rollup of :func:`item_states`: a corpus is reviewed only if all its items are; what blocks it is one reason, or several."""
    every = lambda c, value: F.bool_and(F.col(c) == value)
    out = states.groupBy("corpus").agg(
        F.when(every("status", "reviewed"), "reviewed").otherwise("blocked").alias("status"), F.when(every("gold", "human-reviewed"), "human-reviewed").otherwise("unavailable").alias("gold"), F.sum("units").alias("units"),
        F.count_if(F.col("local") == "ready").alias("local_ready"), F.count_if(F.col("hosted") == "ready").alias("hosted_ready"), F.collect_set(F.when(F.col("decision") != ADMITTED, F.col("decision"))).alias("_open"),
        F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "slot", "evidence"))), "\n"), 256).alias("evidence"),
    )
    decision = F.when(F.col("status") == "reviewed", ADMITTED).when((F.size("_open") == 1) & (F.col("_open")[0] == AWAITED), AWAITED).otherwise(BLOCKERS)
    return out.withColumn("decision", decision).drop("_open")


# What evaluation input may be used for, and on what ground a record is admitted.
USES = ("local-deterministic-grading", "hosted-model-inference")
GROUNDS = ("public_domain", "open_licence", "internal_evaluation_permission", "local_information_analysis")


def dispatch(records: DataFrame, entries: DataFrame, reviews: DataFrame, gold: DataFrame, use: str, provider: str | None = None, route: str | None = None) -> DataFrame:
    """(record_hash, scope, reason) of each record: what of it may be used (whole-record or partial-units-only), or the first reason why nothing may.

    ``records`` has (record_hash, rights); ``entries`` (record_hash, rights, basis, controlled, permission struct<provider,route,use>); ``reviews``
    (record_hash, coverage, digestible); ``gold`` (record_hash, gold_units). Local grading needs a ground, and a permission that covers it where the
    ground is a licence or a permission; hosted models need a whole review and rights that are open by themselves. It fails closed.
    """
    e = entries.select("record_hash", F.lit(True).alias("_entry"), F.col("rights").alias("_rights"), "basis", "controlled", "permission")
    rows = records.join(e, "record_hash", "left").join(reviews, "record_hash", "left").join(gold, "record_hash", "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    whole = yes((F.col("coverage") == 1.0) & F.col("digestible"))
    p = F.col("permission")
    covered = yes((p["provider"] == "local") & (p["route"] == "local") & (p["use"] == use))
    basis = F.col("basis")
    grounds = [
        (yes(basis == "local_information_analysis") & ~yes((F.col("rights") == "publicly_accessible") & F.col("controlled")), "local analysis lacks its controls"),
        (yes(basis.isin("open_licence", "internal_evaluation_permission")) & ~covered, "no permission for this record"),
        (~yes(basis.isin(*GROUNDS)), "not admitted for local grading"),
    ]
    hosted = [(F.lit(not provider or not route), "no route"), (~whole, "source review is not complete"), (~yes(F.col("rights").isin(*OPEN_RIGHTS)), "rights do not permit hosted input")]
    checks = [
        (F.lit(use not in USES), "unknown use"), (F.col("_entry").isNull(), "not in the manifest"), (~F.col("rights").eqNullSafe(F.col("_rights")), "rights differ from the manifest"),
        (~yes(F.trim(basis) != ""), "no ground"), (~yes((F.col("coverage") > 0) & (F.col("coverage") <= 1)), "no usable review"), (~yes(F.col("gold_units") > 0), "no gold"),
        *(grounds if use == USES[0] else hosted),
    ]
    reason = F.coalesce(*(F.when(c, why) for c, why in checks))
    scope = F.when(reason.isNull(), F.when(whole, "whole-record").otherwise("partial-units-only"))
    return rows.select("record_hash", scope.alias("scope"), reason.alias("reason"))
