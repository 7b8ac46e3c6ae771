"""The entailment cascade: a cheap verdict for all, a second one only for neutral claims that were located.

The classifier is injected: a function of (premise, hypothesis) columns to a score column, or a pandas UDF. The default is lexical and
needs no model.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def lexical_support(premise: Column, hypothesis: Column) -> Column:
    """The share of the hypothesis's distinct tokens that the premise has; null without tokens."""
    h = F.array_distinct(T.tokens(hypothesis))
    return F.try_divide(F.size(F.array_intersect(h, T.tokens(premise))).cast("double"), F.size(h))


def label(score: Column, entails: float = 0.5, neutral: float = 0.1) -> Column:
    return F.when(score >= entails, "entails").when(score >= neutral, "neutral").otherwise("contradicts")


def eligible(quote: Column, text: Column) -> Column:
    blank = lambda c: c.isNull() | (F.trim(c) == "")
    return ~blank(quote) & ~blank(text)


def needs_check(claims: DataFrame, digest: str) -> DataFrame:
    """Digests with an eligible claim that no valid label settles."""
    open_ = eligible(F.col("quote"), F.col("text")) & ~F.coalesce(F.col("entailment.label").isin("entails", "neutral", "contradicts"), F.lit(False))
    return claims.groupBy(digest).agg(F.bool_or(open_).alias("needs_check"))


def window_text(body: Column, start: Column, end: Column, around: int = 800) -> Column:
    begin = F.greatest(F.lit(0), start - around)
    return body.substr((begin + 1).cast("int"), (end + around - begin).cast("int"))


def premise(speaker: Column, body: Column) -> Column:
    """What is asked about: the words, after who said them where that is known."""
    return F.when(F.coalesce(speaker, F.lit("")) != "", F.concat(speaker, F.lit(": "), body)).otherwise(body)


def cascade(claims: DataFrame, text: str, quote: str, window: str | None = None, classify: Callable[[Column, Column], Column] = lexical_support, at: str | None = None, force: bool = False, redo_unlocated: bool = False) -> DataFrame:
    """``label``, ``score`` and ``premise`` (quote or window; null where nothing was asked).

    All eligible claims get a first verdict against their quote; those that come out neutral and were located get a second against the window
    round it. The second classifier runs on their rows alone: they are filtered out and united again. ``at`` is the column that says whether a
    claim was located (its window, if there is none). A claim that already has a valid ``entailment`` keeps it, unless ``force``, or unless
    ``redo_unlocated`` and its premise was no window.
    """
    where = F.col(at or window or quote)
    ready = claims.withColumn("_ask", eligible(F.col(quote), F.col(text)))
    if "entailment" in claims.columns and not force:
        settled = F.coalesce(F.col("entailment.label").isin("entails", "neutral", "contradicts"), F.lit(False))
        if redo_unlocated:
            settled &= F.coalesce(F.col("entailment.premise") == "window", F.lit(False)) | (F.col("entailment.label") != "neutral")
        ready = ready.withColumn("_ask", F.col("_ask") & ~settled)
    asked = ready.where("_ask").drop("_ask")
    first = asked.withColumn("score", classify(F.col(quote), F.col(text)))
    again = F.coalesce((label(F.col("score")) == "neutral") & where.isNotNull() & F.lit(window is not None or at is None), F.lit(False))
    once = first.where(~again).withColumn("premise", F.lit("quote"))
    twice = first.where(again).withColumn("score", classify(F.col(window or quote), F.col(text))).withColumn("premise", F.lit("window"))
    out = once.unionByName(twice).withColumn("label", label(F.col("score")))
    rest = ready.where(~F.col("_ask")).drop("_ask")
    if "entailment" in claims.columns:
        rest = rest.withColumn("score", F.col("entailment.score")).withColumn("premise", F.col("entailment.premise")).withColumn("label", F.col("entailment.label"))
    return out.unionByName(rest, allowMissingColumns=True)


def counts(claims: DataFrame, quote: str, text: str, located: str) -> DataFrame:
    """How many claims were assessed, are ineligible, or could not be located."""
    ok = eligible(F.col(quote), F.col(text))
    return claims.agg(F.count_if(F.col("label").isNotNull()).alias("assessed"), F.count_if(~ok).alias("ineligible"), F.count_if(ok & F.col(located).isNull()).alias("unlocated"))


def histogram(assessed: DataFrame) -> DataFrame:
    return assessed.groupBy("label", "premise").agg(F.count(F.lit(1)).alias("claims"))
