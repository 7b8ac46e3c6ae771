"""Fixture evaluation: expectations about a case's claims, decided for each of six dimensions.

All tables have ``case_id``; cases are small and many, and every join is on it.

* concepts: concept_id, terms (array of OR-groups); claims: claim_id, text, refs, date, date_range
* accounts: account_id, claim_ids (predicted); edges: account_id, relation, left, right (predicted, claim ids)
* expected_contexts: expectation, concepts, referents; expected_accounts: expectation, concepts
* expected_dates and expected_references: expectation, concept, any_of; expected_chronology: expectation, account, relation, left, right (concepts)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .validation import violations

# The dimensions, the relations between claims, and what a reference may be to.
DIMENSIONS = ("coverage", "context", "dates", "references", "accounts", "chronology")
RELATIONS = ("before", "simultaneous", "unknown")
KINDS = ("entity", "topic", "event")


def matches(concepts: DataFrame, claims: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """(case_id, concept_id, claim_id, source): claims that name a term of each of a concept's groups, and those that a judge found equivalent.

    ``decisions`` has concept_id, decision and claim_ids; a claim that matches anyway is not counted again.
    """
    named = concepts.join(claims.select("case_id", "claim_id", F.coalesce("text", F.lit("")).alias("text")), "case_id").where(T.concept_match(F.col("text"), F.col("terms")))
    out = named.select("case_id", "concept_id", "claim_id", F.lit("deterministic").alias("source"))
    if decisions is not None:
        judged = decisions.where("decision = 'equivalent'").select("case_id", "concept_id", F.explode("claim_ids").alias("claim_id")).distinct()
        judged = judged.join(claims.select("case_id", "claim_id"), ["case_id", "claim_id"], "left_semi").join(out, ["case_id", "concept_id", "claim_id"], "left_anti")
        out = out.unionByName(judged.withColumn("source", F.lit("semantic_adjudication")))
    return out


def _result(rows: DataFrame, dimension: str, hits: DataFrame) -> DataFrame:
    """(case_id, dimension, expectation, passed) of expectations, passed where ``hits`` has them."""
    found = rows.select("case_id", "expectation").join(hits.select("case_id", "expectation").distinct().withColumn("_hit", F.lit(True)), ["case_id", "expectation"], "left")
    return found.select("case_id", F.lit(dimension).alias("dimension"), "expectation", F.coalesce("_hit", F.lit(False)).alias("passed"))


def coverage(concepts: DataFrame, matched: DataFrame) -> DataFrame:
    return _result(concepts.withColumnRenamed("concept_id", "expectation"), "coverage", matched.withColumnRenamed("concept_id", "expectation"))


def members(accounts: DataFrame) -> DataFrame:
    return accounts.select("case_id", "account_id", F.explode(F.array_distinct("claim_ids")).alias("claim_id"))


def account_candidates(expected: DataFrame, accounts: DataFrame, matched: DataFrame) -> DataFrame:
    """(case_id, expectation, account_id): the accounts that hold a match of every concept that is asked for."""
    need = expected.select("case_id", "expectation", F.explode(F.array_distinct("concepts")).alias("concept_id"), F.size(F.array_distinct("concepts")).alias("_all"))
    have = members(accounts).join(matched, ["case_id", "claim_id"]).select("case_id", "account_id", "concept_id").distinct()
    return need.join(have, ["case_id", "concept_id"]).groupBy("case_id", "expectation", "account_id", "_all").agg(F.count(F.lit(1)).alias("_n")).where("_n = _all").select("case_id", "expectation", "account_id")


def contexts(expected: DataFrame, accounts: DataFrame, claims: DataFrame, matched: DataFrame) -> DataFrame:
    """Passed if some candidate account names a required referent, in the texts of its claims or their references, taken together."""
    parts = members(accounts).join(claims.select("case_id", "claim_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.transform("refs", lambda r: F.coalesce(r["name"], F.lit(""))), F.array().cast("array<string>")).alias("names")), ["case_id", "claim_id"])
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("claim_id", "text", "names"))), lambda x: x)
    said = parts.groupBy("case_id", "account_id").agg(ordered.alias("xs")).select("case_id", "account_id", F.concat_ws(" ", F.transform("xs", lambda x: x["text"]), F.flatten(F.transform("xs", lambda x: x["names"]))).alias("said"))
    tried = account_candidates(expected, accounts, matched).join(expected.select("case_id", "expectation", "referents"), ["case_id", "expectation"]).join(said, ["case_id", "account_id"])
    return _result(expected, "context", tried.where(F.exists("referents", lambda r: T.padded_contains(F.col("said"), r))))


def dates(expected: DataFrame, claims: DataFrame, matched: DataFrame) -> DataFrame:
    """Passed if a matching claim's date equals an alternative; ``any_of`` holds arrays of one date or the two ends of a range, and a range wins over a date."""
    own = claims.select("case_id", "claim_id", F.coalesce("date_range", F.when(F.col("date").isNotNull(), F.array("date"))).alias("when")).where("`when` is not null")
    seen = expected.join(matched.withColumnRenamed("concept_id", "concept"), ["case_id", "concept"]).join(own, ["case_id", "claim_id"])
    return _result(expected, "dates", seen.where(F.array_contains("any_of", F.col("when"))))


def normal(c: Column) -> Column:
    """Letters and digits alone, other runs as one space."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def references(expected: DataFrame, claims: DataFrame, matched: DataFrame) -> DataFrame:
    """Passed if a matching claim refers to an alternative, by name or else by id, after normalisation."""
    own = claims.select("case_id", "claim_id", F.explode("refs").alias("r")).select("case_id", "claim_id", F.coalesce(F.nullif(F.col("r.name"), F.lit("")), F.nullif(F.col("r.id"), F.lit(""))).alias("name")).where("name is not null")
    seen = expected.join(matched.withColumnRenamed("concept_id", "concept"), ["case_id", "concept"]).join(own, ["case_id", "claim_id"])
    return _result(expected, "references", seen.where(F.exists("any_of", lambda w: normal(w) == normal(F.col("name")))))


def accounts_dimension(expected: DataFrame, accounts: DataFrame, matched: DataFrame) -> DataFrame:
    return _result(expected, "accounts", account_candidates(expected, accounts, matched))


def chronology(expected: DataFrame, expected_accounts: DataFrame, accounts: DataFrame, edges: DataFrame, matched: DataFrame) -> DataFrame:
    """Passed if an account that matches the expected one holds an edge of that relation between matches of both concepts; only ``before`` has a direction."""
    at = account_candidates(expected_accounts, accounts, matched).withColumnRenamed("expectation", "account")
    side = lambda name: matched.select("case_id", F.col("concept_id").alias(name), F.col("claim_id").alias(f"{name}_claim"))
    asked = expected.join(at, ["case_id", "account"]).join(side("left"), ["case_id", "left"]).join(side("right"), ["case_id", "right"])
    turned = edges.where("relation <> 'before'").select("case_id", "account_id", "relation", F.col("right").alias("left"), F.col("left").alias("right"))
    known = edges.select("case_id", "account_id", "relation", "left", "right").unionByName(turned).distinct().withColumnsRenamed({"left": "left_claim", "right": "right_claim"})
    return _result(expected, "chronology", asked.join(known, ["case_id", "account_id", "relation", "left_claim", "right_claim"], "left_semi"))


def dimension_table(results: DataFrame) -> DataFrame:
    """(case_id, dimension, passed, total, rate) of each case and of all ('*'): every dimension has a row, if need be with a total of 0 and no rate."""
    spark = results.sparkSession
    every = spark.createDataFrame([(d,) for d in DIMENSIONS], "dimension string")
    cases = results.select("case_id").distinct().unionByName(spark.createDataFrame([("*",)], "case_id string"))
    counts = results.unionByName(results.withColumn("case_id", F.lit("*"))).groupBy("case_id", "dimension").agg(F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("total"))
    out = cases.crossJoin(F.broadcast(every)).join(counts, ["case_id", "dimension"], "left").na.fill(0, ["passed", "total"])  # six rows
    return out.withColumn("rate", F.try_divide(F.col("passed").cast("double"), F.col("total")))


def _key(*parts: str) -> Column:
    return F.concat_ws("/", *parts)


def expectation_violations(concepts: DataFrame, **expected: DataFrame) -> DataFrame:
    """(key, rule) rows of a fixture that breaks its contract; none means valid. ``expected`` holds the tables contexts, accounts, dates, references and chronology."""
    filled = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    texts = lambda c: (F.size(c) > 0) & F.forall(c, lambda x: F.coalesce(F.trim(x) != "", F.lit(False)))
    found = [
        violations(concepts.withColumn("key", _key("case_id", "concept_id")), "key", id=filled("concept_id"), terms=(F.size("terms") > 0) & F.forall("terms", texts)),
        _repeated(concepts, "concept_id"),
    ]
    known = concepts.groupBy("case_id").agg(F.collect_set("concept_id").alias("_known"))
    empty = F.array().cast("array<string>")
    named = lambda df: df.withColumn("key", _key("case_id", "expectation")).join(known, "case_id", "left").withColumn("_known", F.coalesce("_known", empty))
    for name, rows in expected.items():
        found.append(_repeated(rows, "expectation"))
        rules = {"id": filled("expectation")}
        checked = named(rows)
        if name in ("contexts", "accounts"):
            rules |= {"two concepts": F.size("concepts") >= 2, "known concepts": F.size(F.array_except("concepts", F.col("_known"))) == 0}
        if name == "contexts":
            rules["referents"] = texts(F.col("referents"))
        if name in ("dates", "references"):
            rules |= {"known concept": F.array_contains("_known", F.col("concept")), "alternatives": F.size("any_of") > 0}
        if name == "dates":
            rules["dates"] = F.forall("any_of", lambda x: F.size(x).between(1, 2) & F.forall(x, lambda y: y.isNotNull()))
        if name == "references":
            rules |= {"names": texts(F.col("any_of")), "kind": F.col("kind").isin(*KINDS)}
        if name == "chronology":
            accounts = expected["accounts"].groupBy("case_id").agg(F.collect_set("expectation").alias("_accounts"))
            checked = checked.join(accounts, "case_id", "left").withColumn("_accounts", F.coalesce("_accounts", empty))
            rules |= {
                "known account": F.array_contains("_accounts", F.col("account")), "relation": F.col("relation").isin(*RELATIONS), "two concepts": F.col("left") != F.col("right"),
                "known concepts": F.array_contains("_known", F.col("left")) & F.array_contains("_known", F.col("right")),
            }
        found.append(violations(checked, "key", **rules))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _repeated(rows: DataFrame, name: str) -> DataFrame:
    twice = rows.groupBy("case_id", name).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.select(_key("case_id", name).alias("key"), F.lit("duplicate id").alias("rule"))


def prediction_violations(claims: DataFrame, accounts: DataFrame, edges: DataFrame) -> DataFrame:
    """(key, rule) rows of a prediction: ids unique, accounts of known claims, a claim in one account, edges between two claims of their account."""
    inside = members(accounts)
    unknown = inside.join(claims.select("case_id", "claim_id"), ["case_id", "claim_id"], "left_anti").select(_key("case_id", "account_id", "claim_id").alias("key"), F.lit("unknown claim").alias("rule"))
    shared = inside.groupBy("case_id", "claim_id").agg(F.countDistinct("account_id").alias("n")).where("n > 1").select(_key("case_id", "claim_id").alias("key"), F.lit("several accounts").alias("rule"))
    bare = violations(accounts.withColumn("key", _key("case_id", "account_id")), "key", claims=F.size("claim_ids") > 0)
    named = edges.withColumn("key", _key("case_id", "account_id", "left", "right"))
    ends = named.select("case_id", "account_id", "key", F.explode(F.array("left", "right")).alias("claim_id"))
    escaped = ends.join(inside, ["case_id", "account_id", "claim_id"], "left_anti").select("key", F.lit("escapes its account").alias("rule")).distinct()
    pairs = violations(named, "key", pair=F.col("left") != F.col("right"), relation=F.col("relation").isin(*RELATIONS))
    return _repeated(claims, "claim_id").unionByName(_repeated(accounts, "account_id")).unionByName(unknown).unionByName(shared).unionByName(bare).unionByName(escaped).unionByName(pairs)


def adjudication_violations(decisions: DataFrame, concepts: DataFrame, claims: DataFrame, fixture_sha: str, prediction_sha: str) -> DataFrame:
    """(key, rule) rows of a judge's decisions (case_id, concept_id, decision, claim_ids, rationale, fixture_sha, prediction_sha): bound to both files' hashes, over known concepts and claims, reasoned."""
    own = claims.groupBy("case_id").agg(F.collect_set("claim_id").alias("_claims"))
    rows = decisions.join(concepts.select("case_id", "concept_id", F.lit(True).alias("_concept")), ["case_id", "concept_id"], "left").join(own, "case_id", "left").withColumn("key", _key("case_id", "concept_id"))
    claims_known = F.size(F.array_except("claim_ids", F.coalesce("_claims", F.array().cast("array<string>")))) == 0
    return violations(
        rows, "key", fixture=F.col("fixture_sha") == fixture_sha, prediction=F.col("prediction_sha") == prediction_sha, concept=F.col("_concept"), decision=F.col("decision").isin("equivalent", "not_equivalent"),
        claims=claims_known & ((F.col("decision") != "equivalent") | (F.size("claim_ids") > 0)), rationale=F.trim("rationale") != "",
    )
