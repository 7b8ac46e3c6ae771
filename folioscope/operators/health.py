"""Corpus health: yields, caches, survival, unmapped fields, costs, progressions and repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import medians

LOW_SHARE, LEAST_PEERS, LEAST_CHARS, LOW_CACHE, LEAST_CALLS, LOW_SURVIVAL = 0.35, 5, 20_000, 0.30, 6, 0.5


def claim_yield(digests: DataFrame) -> DataFrame:
    """Claims per thousand characters, of records long enough to tell."""
    return digests.where(F.col("chars") >= LEAST_CHARS).withColumn("rate", F.col("claims") / (F.col("chars") / 1000))


def low_yield(rows: DataFrame, kind: str, family: str, rate: str) -> DataFrame:
    """Rows under 0.35 of the median of their kind, or of their family or the corpus where there are fewer than five peers."""

    out = rows.join(medians(rows, [kind], rate, "kind"), kind).join(medians(rows, [family], rate, "family"), family).crossJoin(F.broadcast(medians(rows, [], rate, "all")))  # one row
    pick = F.when(F.col("n_kind") >= LEAST_PEERS, F.col("m_kind")).when(F.col("n_family") >= LEAST_PEERS, F.col("m_family")).when(F.col("n_all") >= LEAST_PEERS, F.col("m_all"))
    return out.withColumn("median", pick).where(F.col(rate) < LOW_SHARE * F.col("median")).select(*rows.columns, "median")


def cache_ratio(usage: DataFrame) -> DataFrame:
    """Cache reads over writes of runs with six calls or more; runs without writes are no evidence."""
    out = usage.where((F.col("calls") >= LEAST_CALLS) & (F.col("writes") > 0)).withColumn("ratio", F.try_divide(F.col("reads").cast("double"), F.col("writes")))
    return out.withColumn("collapsed", F.col("ratio") < LOW_CACHE)


def stale_records(states: DataFrame, key: str = "record") -> DataFrame:
    """The records that must be read again: their text changed, or the preparation of it did."""
    return states.where(F.col("state").isin("record_changed", "prep_version")).select(key, "state").distinct()


def survival(records: DataFrame) -> DataFrame:
    """Characters that preparation leaves, over those of the text without timestamps."""
    return records.withColumn("survival", F.try_divide(F.length("materialised").cast("double"), F.length("plain"))).withColumn("over_marked", F.col("survival") < LOW_SURVIVAL)


def unmapped_fields(rows: DataFrame, keys: Column, known: list[str]) -> DataFrame:
    """Records per field name outside the known ones."""
    out = rows.select(F.explode(F.array_distinct(keys)).alias("key")).where(~F.col("key").isin(known))
    return out.groupBy("key").agg(F.count(F.lit(1)).alias("records"))


def progression(rows: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """Running totals."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(*keys, order, *(F.sum(v).over(w).alias(v) for v in values))


def carry_forward(rows: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """The last value so far."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(w))


def repeat_statistics(rows: DataFrame, key: str, value: str) -> DataFrame:
    return rows.groupBy(key).agg(F.avg(value).alias("mean"), (F.max(value) - F.min(value)).alias("spread"), F.stddev_samp(value).alias("stdev"), F.count(F.lit(1)).alias("runs"))


def complete_separation(rows: DataFrame, key: str) -> DataFrame:
    """Whether all of arm a lie above all of arm b, or below."""
    of = lambda arm, f: f(F.when(F.col("arm") == arm, F.col("value")))
    return rows.groupBy(key).agg(((of("a", F.min) > of("b", F.max)) | (of("b", F.min) > of("a", F.max))).alias("separated"))


def run_costs(rows: DataFrame, model: str, node: str, cost: str) -> DataFrame:
    """Nodes, claims and cost of each model, and claims for each unit of cost."""
    cents = F.sum(F.round(F.col(cost) * 100).cast("long"))
    out = rows.groupBy(F.col(model).alias("model")).agg(F.countDistinct(node).alias("nodes"), F.count(F.lit(1)).alias("claims"), cents.alias("cost_cents"))
    return out.withColumn("claims_per_usd", F.round(F.try_divide(F.col("claims").cast("double"), F.col("cost_cents") / 100.0), 12))


def ledger_gap(recorded: DataFrame, provider: DataFrame, most: float = 0.01) -> DataFrame:
    """Spend by type where both ledgers differ by more than a cent."""
    a = recorded.groupBy("type").agg(F.sum("usd").alias("recorded"))
    b = provider.groupBy("type").agg(F.sum("usd").alias("billed"))
    out = a.join(b, "type", "full").na.fill(0.0, ["recorded", "billed"]).withColumn("gap", F.col("billed") - F.col("recorded"))
    return out.where(F.abs("gap") > most)


def findings(**checks: DataFrame) -> DataFrame:
    """All findings as (check, status, key, detail); a check without a row is itself reported, so silence is no pass."""
    out = None
    for name, df in checks.items():
        rows = df.select(F.lit(name).alias("check"), F.lit("finding").alias("status"), F.col("key").cast("string").alias("key"), F.col("detail").cast("string").alias("detail"))
        none = df.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit(name).alias("check"), F.lit("nothing").alias("status"), F.lit("").alias("key"), F.lit("").alias("detail"))
        both = rows.unionByName(none)
        out = both if out is None else out.unionByName(both)
    return out
