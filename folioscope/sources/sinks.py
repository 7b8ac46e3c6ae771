"""Sinks for digests, curation and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .digests import production, refresh_apply, write_variants


def write_digests(rows: DataFrame, variants: str, canonical: str) -> None:
    """Every digest as a variant, stamped with what kind of run it is from, and those of production runs as their record's canonical digest."""
    best = production(rows)
    key = ["record", "model", "prompt_sha8", "run_label"]
    kind = best.select(*key, F.lit("production").alias("run_kind"))
    stamped = rows.drop("run_kind").join(kind, key, "left").withColumn("run_kind", F.coalesce("run_kind", F.lit("variant")))
    write_variants(stamped, variants)
    best.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("record").parquet(canonical)


def refreshed(current: DataFrame, plan: DataFrame, fields: list[str], at: str, key: str = "record") -> tuple[DataFrame, DataFrame]:
    """The headers with their planned changes, and a curation row (key, at, action, fields) for each record that changed."""
    notes = plan.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("field", "old", "new"))).alias("fields"))
    return refresh_apply(current, plan, fields, key), notes.select(key, F.lit(at).alias("at"), F.lit("refresh").alias("action"), "fields")


def write_json(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def append_history(report: DataFrame, path: str, at: str) -> None:
    """One more line for each row; nothing that is there is read or written again."""
    report.withColumn("at", F.lit(at)).write.mode("append").json(path)


def markdown(report: DataFrame, most: int = 500) -> str:
    """A report table as Markdown: reports are small, and one of more than ``most`` rows is refused rather than cut."""
    rows = report.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows are no report")
    show = lambda v: "" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v).replace("|", "\\|").replace("\n", " ")
    line = lambda cells: "| " + " | ".join(cells) + " |"
    return "\n".join([line(report.columns), line(["-"] * len(report.columns)), *(line([show(v) for v in r]) for r in rows)])
