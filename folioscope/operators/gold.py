"""Gold for a record's highlights and accounts: violation queries, derived states and the chronology score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapsed
from ..schemas import DECISIONS
from . import graph
from .grade import crosses, inside_all
from .spans import exact_container, multipart_iou
from .validation import reviewer, violations

# Fixed value: the facts that a decision must come with, at least.
FACTS = {"accept": 1, "adjust": 1, "split": 2}


def _key(*parts: str) -> Column:
    return F.concat_ws("/", *parts)


def _union(found: list[DataFrame]) -> DataFrame:
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f.select("key", "rule"))
    return out


def overlapping(spans: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """(key, rule) for spans that begin before their predecessor ends."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    return spans.withColumn("_p", F.lag("end").over(w)).where("_p > start").select(_key(*keys).alias("key"), F.lit(rule).alias("rule")).distinct()


def range_states(ranges: DataFrame, highlights: DataFrame) -> DataFrame:
    """Ranges with the ids of the highlights they contain, and of those that cross their border. ``highlights`` has (record_key, unit_id, spans)."""
    both = ranges.select("record_key", "range_id", "start", "end").join(highlights.select("record_key", "unit_id", "spans"), "record_key", "left")
    ids = lambda c: F.array_sort(F.collect_set(F.when(c, F.col("unit_id"))))
    got = both.groupBy("record_key", "range_id").agg(ids(inside_all(F.col("spans"), F.col("start"), F.col("end"))).alias("contained"), ids(crosses(F.col("spans"), F.col("start"), F.col("end"))).alias("boundary"))
    return ranges.join(got, ["record_key", "range_id"], "left")


def highlight_gold_violations(records: DataFrame, ranges: DataFrame, units: DataFrame, highlights: DataFrame, unresolved: DataFrame) -> DataFrame:
    """(key, rule) rows of review ranges over a record's highlights; none means valid.

    ``records`` has (record_key, body, record_hash, body_sha256 as declared, declared_hash); ``ranges`` (record_key, range_id, start, end, complete,
    reviewer struct<issuer,subject,name>, updated_at, attested_at); ``units`` (record_key, range_id, pos, unit_id, decision, facts);
    ``highlights`` (record_key, unit_id, pos, spans); ``unresolved`` (record_key, unit_id) of units whose context is not known.
    """
    whole = violations(records, "record_key", record=F.col("declared_hash") == F.col("record_hash"), body=F.col("body_sha256") == F.concat(F.lit("sha256:"), F.sha2("body", 256)))
    named = ranges.withColumn("key", _key("record_key", "range_id")).join(records.select("record_key", F.length("body").alias("n_chars")), "record_key", "left")
    who = F.col("reviewer")
    filled = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    bounds = violations(
        named, "key", id=filled("range_id"), offsets=(F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.col("n_chars")),
        identity=filled(who["issuer"]) & filled(who["subject"]) & filled(who["name"]), updated=reviewer(who["name"], F.col("updated_at")), complete=F.col("complete").isNotNull(),
        attested=F.when(F.col("complete"), reviewer(who["name"], F.col("attested_at"))).otherwise(F.col("attested_at").isNull()),
    )
    twice = ranges.groupBy("record_key", "range_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(_key("record_key", "range_id").alias("key"), F.lit("duplicate range").alias("rule"))
    state = range_states(ranges, highlights).select("record_key", "range_id", "complete", "contained")
    open_ = unresolved.select("record_key", "unit_id").distinct().withColumn("_open", F.lit(True))
    u = units.join(state, ["record_key", "range_id"], "left").join(highlights.select("record_key", "unit_id", F.col("pos").alias("_at")), ["record_key", "unit_id"], "left").join(open_, ["record_key", "unit_id"], "left")
    n, need = F.size(F.coalesce("facts", F.array().cast("array<string>"))), F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in FACTS.items() for x in kv]), F.col("decision")), F.lit(0))
    facts = F.when(need == 0, F.col("facts").isNull()).otherwise((n >= need) & F.forall("facts", filled) & ((F.col("decision") != "accept") | (n == 1)))
    order = Window.partitionBy("record_key", "range_id").orderBy("pos")
    each = violations(
        u.withColumn("_before", F.lag("_at").over(order)).withColumn("key", _key("record_key", "range_id", "unit_id")), "key", in_range=F.array_contains("contained", F.col("unit_id")), order=F.col("_before").isNull() | (F.col("_before") <= F.col("_at")),
        decision=F.col("decision").isin(*DECISIONS), facts=facts, context=F.col("_open").isNull() | (F.col("decision") == "defer"),
    )
    again = units.groupBy("record_key", "range_id", "unit_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(_key("record_key", "range_id", "unit_id").alias("key"), F.lit("duplicate unit").alias("rule"))
    decided = units.groupBy("record_key", "range_id").agg(F.collect_set("unit_id").alias("_units"), F.bool_or(F.col("decision") == "defer").alias("_deferred"))
    waiting = unresolved.groupBy("record_key").agg(F.collect_set("unit_id").alias("_waiting"))
    empty = F.array().cast("array<string>")
    done = state.where("complete").join(decided, ["record_key", "range_id"], "left").join(waiting, "record_key", "left").withColumn("key", _key("record_key", "range_id"))
    finished = violations(
        done, "key", all_decided=(F.array_sort(F.coalesce("_units", empty)) == F.col("contained")) & ~F.coalesce("_deferred", F.lit(False)), resolved=F.size(F.array_intersect("contained", F.coalesce("_waiting", empty))) == 0
    )
    return _union([whole, bounds, twice, each, again, finished, overlapping(ranges, ["record_key"], "ranges overlap")])


def next_batch(ranges: DataFrame, highlights: DataFrame, units: DataFrame, closures: DataFrame, claims: DataFrame, limit: int = 5) -> DataFrame:
    """What to review next: of each record's first incomplete range the first ``limit`` units (3 to 5) that are undecided, and then those deferred.

    (record_key, range_id, nth, unit_id, linked, proposals): the units it leans on in order of place, and the facts that claims over its parts
    propose, once for each normal text with every model that made it. ``claims`` has (record_key, model, text, spans, ord).
    """
    if not 3 <= limit <= 5:
        raise ValueError("a batch is of 3 to 5 units")
    first = ranges.where("not complete").groupBy("record_key").agg(F.min_by(F.struct("range_id", "start", "end"), F.struct("start", "range_id")).alias("r")).select("record_key", "r.*")
    inside = first.join(highlights.select("record_key", "unit_id", F.col("pos").alias("_at"), "spans"), "record_key").where(inside_all(F.col("spans"), F.col("start"), F.col("end")))
    state = inside.join(units.select("record_key", "range_id", "unit_id", "decision"), ["record_key", "range_id", "unit_id"], "left").where("decision is null or decision = 'defer'")
    order = Window.partitionBy("record_key").orderBy(F.col("decision").isNotNull(), "_at")
    chosen = state.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= limit)
    ahead = highlights.select("record_key", F.col("unit_id").alias("ancestor"), F.col("pos").alias("_place"))
    linked = closures.withColumnRenamed("dependent", "unit_id").join(ahead, ["record_key", "ancestor"]).groupBy("record_key", "unit_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", "ancestor"))), lambda x: x["ancestor"]).alias("linked"))
    parts = chosen.select("record_key", "unit_id", F.explode("spans").alias("p"))
    said = claims.where("trim(text) <> ''").select("record_key", "model", "text", "ord", F.explode("spans").alias("c"))
    near = parts.join(said, "record_key").where("greatest(p.start, c.start) < least(p.end, c.end)").withColumn("_norm", collapsed(F.lower("text")))
    facts = near.groupBy("record_key", "unit_id", "_norm").agg(F.min("ord").alias("_first"), F.min_by("text", "ord").alias("fact"), F.array_sort(F.collect_set("model")).alias("models"))
    proposed = facts.groupBy("record_key", "unit_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_first", "fact", "models"))), lambda x: F.struct(x["fact"].alias("fact"), x["models"].alias("models"))).alias("proposals"))
    out = chosen.join(linked, ["record_key", "unit_id"], "left").join(proposed, ["record_key", "unit_id"], "left")
    return out.select("record_key", "range_id", "nth", "unit_id", F.coalesce("linked", F.array().cast("array<string>")).alias("linked"), "proposals")


def accepted_facts(units: DataFrame) -> DataFrame:
    """(record_key, range_id, unit_id, fact) of units that were accepted as they are, adjusted or split."""
    return units.where(F.col("decision").isin(*FACTS)).select("record_key", "range_id", "unit_id", F.explode("facts").alias("fact"))


def external_gold_violations(records: DataFrame, highlights: DataFrame, ranges: DataFrame) -> DataFrame:
    """(key, rule) rows of gold that brings its own text: spans match the body, don't overlap, lie in a reviewed range, and say who marked them.

    ``highlights`` has (record_key, unit_id, start, end, text, reviewed_by); ``ranges`` (record_key, start, end).
    """
    h = highlights.join(records.select("record_key", "body"), "record_key", "left").withColumn("key", _key("record_key", "unit_id"))
    inside = h.join(ranges.select("record_key", F.col("start").alias("r0"), F.col("end").alias("r1")), "record_key").where("start >= r0 and end <= r1").select("key").distinct().withColumn("_in", F.lit(True))
    cut = F.substring(F.col("body"), F.col("start") + 1, F.col("end") - F.col("start"))
    each = violations(
        h.join(inside, "key", "left"), "key", offsets=(F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.length("body")), text=cut == F.col("text"), provenance=F.trim("reviewed_by") != "", range=F.col("_in")
    )
    return _union([each, overlapping(highlights, ["record_key"], "highlights overlap"), overlapping(ranges, ["record_key"], "ranges overlap")])


def chronology_violations(spans: DataFrame, parents: DataFrame, claims: DataFrame, assignments: DataFrame, pairs: DataFrame) -> DataFrame:
    """(key, rule) rows of a record's accounts, assignments and ordered pairs; none means valid.

    ``spans`` has (record_key, account_id, start, end), half open; ``parents`` (record_key, account_id, parent); ``claims`` (record_key, claim_id,
    position); ``assignments`` (record_key, claim_id, account_id, status: bound, outside or unlocatable); ``pairs`` (record_key, account_id,
    relation: before, unknown or simultaneous, left, right).
    """
    k = ["record_key"]
    shape = violations(spans.withColumn("key", _key("record_key", "account_id")), "key", span=(F.col("start") >= 0) & (F.col("start") < F.col("end")))
    clash = overlapping(spans, ["record_key", "account_id"], "account spans overlap")
    up = spans.select("record_key", F.col("account_id").alias("parent"), F.col("start").alias("p0"), F.col("end").alias("p1"))
    known = spans.select("record_key", "account_id").distinct()
    orphan = parents.join(known.withColumnRenamed("account_id", "parent"), [*k, "parent"], "left_anti").unionByName(parents.where("parent = account_id")).select(_key("record_key", "account_id").alias("key"), F.lit("invalid parent").alias("rule")).distinct()
    child = parents.where("parent <> account_id").join(spans, [*k, "account_id"])
    held = child.join(up, [*k, "parent"]).where("p0 <= start and end <= p1").select("record_key", "account_id", "start", "end").distinct()
    escapes = child.join(known.withColumnRenamed("account_id", "parent"), [*k, "parent"], "left_semi").join(held, [*k, "account_id", "start", "end"], "left_anti").select(_key("record_key", "account_id").alias("key"), F.lit("escapes its parent").alias("rule")).distinct()
    loops = graph.cycles(parents.select("record_key", F.col("account_id").alias("before"), F.col("parent").alias("after")), k).select(_key("record_key", "id").alias("key"), F.lit("parent cycle").alias("rule"))

    points = claims.select("record_key", "claim_id", "position")
    bound = exact_container(points.where("position is not null"), spans, k, "claim_id", "position", "account_id").select("record_key", "claim_id", F.col("bound").alias("_narrowest"))
    touched = points.join(spans, k).where("position >= start and position < end").select("record_key", "claim_id").distinct().withColumn("_inside", F.lit(True))
    a = assignments.join(points.withColumn("_known", F.lit(True)), [*k, "claim_id"], "left").join(bound, [*k, "claim_id"], "left").join(touched, [*k, "claim_id"], "left").withColumn("key", _key("record_key", "claim_id"))
    status = F.col("status")
    holds = (
        F.when(status == "bound", F.col("position").isNotNull() & (F.col("account_id") == F.col("_narrowest")))
        .when(status == "outside", F.col("account_id").isNull() & F.col("position").isNotNull() & F.col("_inside").isNull())
        .when(status == "unlocatable", F.col("account_id").isNull() & F.col("position").isNull())
    )
    placed = violations(a, "key", claim=F.col("_known"), status=status.isin("bound", "outside", "unlocatable"), binding=holds)
    twice = assignments.groupBy("record_key", "claim_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(_key("record_key", "claim_id").alias("key"), F.lit("assigned twice").alias("rule"))
    missing = claims.join(assignments, [*k, "claim_id"], "left_anti").select(_key("record_key", "claim_id").alias("key"), F.lit("not assigned").alias("rule"))

    ends = pairs.withColumn("key", _key("record_key", "account_id", "left", "right"))
    own = assignments.where("status = 'bound'").select("record_key", "account_id", F.col("claim_id").alias("end"))
    stray = ends.select("record_key", "account_id", "key", F.explode(F.array("left", "right")).alias("end")).join(own, [*k, "account_id", "end"], "left_anti").select("key", F.lit("crosses its account").alias("rule")).distinct()
    edges = violations(ends, "key", endpoints=F.col("left") != F.col("right"), relation=F.col("relation").isin("before", "unknown", "simultaneous"))
    repeated = pairs.where("relation = 'before'").groupBy("record_key", "account_id", "left", "right").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(_key("record_key", "account_id", "left", "right").alias("key"), F.lit("repeated pair").alias("rule"))
    order = before_closure(pairs)
    cycle = order.where("before = after").select(_key("record_key", "account_id", "before").alias("key"), F.lit("cycle").alias("rule")).distinct()
    labels = unordered(order.select("record_key", "account_id", F.lit("before").alias("relation"), F.col("before").alias("left"), F.col("after").alias("right"))).unionByName(unordered(pairs.where("relation <> 'before'")))
    clashes = labels.groupBy("record_key", "account_id", "low", "high").agg(F.countDistinct("relation").alias("n")).where("n > 1").select(_key("record_key", "account_id", "low", "high").alias("key"), F.lit("contradiction").alias("rule"))
    return _union([shape, clash, orphan, escapes, loops, placed, twice, missing, stray, edges, repeated, cycle, clashes])


def unordered(pairs: DataFrame) -> DataFrame:
    """(record_key, account_id, relation, low, high), whichever way round."""
    return pairs.select("record_key", "account_id", "relation", F.least("left", "right").alias("low"), F.greatest("left", "right").alias("high")).distinct()


def before_closure(pairs: DataFrame) -> DataFrame:
    """(record_key, account_id, before, after), closed within each account."""
    edges = pairs.where("relation = 'before'").select("record_key", "account_id", F.col("left").alias("a"), F.col("right").alias("b"))
    return graph.closure(edges, ["record_key", "account_id"]).withColumnsRenamed({"a": "before", "b": "after"})


def account_ious(gold: DataFrame, predicted: DataFrame, least: float = 0.5) -> DataFrame:
    """(record_key, gold, predicted, score): pairs of a record's accounts by the intersection over union of their spans, from ``least`` on."""
    pairs = gold.select("record_key", F.col("account_id").alias("gold")).distinct().join(predicted.select("record_key", F.col("account_id").alias("predicted")).distinct(), "record_key")
    left = pairs.join(gold.select("record_key", F.col("account_id").alias("gold"), "start", "end"), ["record_key", "gold"])
    right = pairs.join(predicted.select("record_key", F.col("account_id").alias("predicted"), "start", "end"), ["record_key", "predicted"])
    return multipart_iou(left, right, ["record_key", "gold", "predicted"]).withColumnRenamed("iou", "score").where(F.col("score") >= least)


# What may come of a chronology's assertions.
OUTCOMES = ("correct", "wrong_direction", "abstained", "unknown_assertions", "simultaneous_errors", "unsupported_assertions", "unmatched_account_assertions")


def chronology_score(gold: DataFrame, predicted: DataFrame, matches: DataFrame) -> DataFrame:
    """Counts of each outcome for each record, zeros included.

    ``gold`` and ``predicted`` have (record_key, account_id, relation, left, right); ``matches`` (record_key, gold, predicted) maps predicted accounts
    to gold ones. Gold pairs are correct, turned round or abstained from; asserted pairs of matched accounts that gold labels unknown or
    simultaneous, or does not order at all, are errors of their own, and so is every assertion within an account that has no match.
    """
    k = ["record_key", "account_id"]
    truth, said = before_closure(gold), before_closure(predicted)
    own = matches.select("record_key", F.col("predicted").alias("account_id"), F.col("gold").alias("_gold"))
    mapped = said.join(own, k).select("record_key", F.col("_gold").alias("account_id"), "before", "after").distinct()
    turned = lambda df: df.select(*k, F.col("after").alias("before"), F.col("before").alias("after"))
    mark = lambda df, name: df.select(*k, "before", "after").distinct().withColumn(name, F.lit(True))
    kept = truth.join(mark(mapped, "_same"), [*k, "before", "after"], "left").join(mark(turned(mapped), "_turned"), [*k, "before", "after"], "left")
    judged = kept.select("record_key", F.when(F.col("_same"), "correct").when(F.col("_turned"), "wrong_direction").otherwise("abstained").alias("outcome"))
    loose = unordered(gold.where("relation <> 'before'")).groupBy(*k, "low", "high").agg(F.max(F.col("relation") == "unknown").alias("_unknown"))
    claimed = mapped.withColumn("low", F.least("before", "after")).withColumn("high", F.greatest("before", "after")).join(loose, [*k, "low", "high"], "left")
    claimed = claimed.join(mark(truth, "_same"), [*k, "before", "after"], "left").join(mark(turned(truth), "_turned"), [*k, "before", "after"], "left")
    wrong = F.when(F.col("_unknown"), "unknown_assertions").when(F.col("_unknown").isNotNull(), "simultaneous_errors").when(F.col("_same").isNull() & F.col("_turned").isNull(), "unsupported_assertions")
    errors = claimed.select("record_key", wrong.alias("outcome")).where("outcome is not null")
    lost = said.join(own, k, "left_anti").select("record_key", F.lit("unmatched_account_assertions").alias("outcome"))
    every = gold.select("record_key").unionByName(predicted.select("record_key")).distinct().select("record_key", F.explode(F.array(*map(F.lit, OUTCOMES))).alias("outcome"))
    counts = judged.unionByName(errors).unionByName(lost).groupBy("record_key", "outcome").agg(F.count(F.lit(1)).alias("n"))
    return every.join(counts, ["record_key", "outcome"], "left").na.fill(0, ["n"])


def assignment_score(gold: DataFrame, predicted: DataFrame, matches: DataFrame) -> DataFrame:
    """(record_key, claim_id, outcome): correct where the mapped account or the reason for none is gold's; abstained, or a wrong account."""
    own = matches.select("record_key", F.col("predicted").alias("_account"), F.col("gold").alias("_mapped"))
    both = gold.join(predicted.select("record_key", "claim_id", F.col("account_id").alias("_account"), F.col("status").alias("_status")), ["record_key", "claim_id"], "left").join(own, ["record_key", "_account"], "left")
    none = F.col("account_id").isNull() & F.col("_account").isNull() & (F.col("status") == F.col("_status"))
    outcome = F.when(none | (F.col("_mapped") == F.col("account_id")), "correct").when(F.col("_account").isNull() & F.col("account_id").isNotNull(), "abstained").otherwise("wrong_account")
    return both.select("record_key", "claim_id", outcome.alias("outcome"))
