"""The extraction passes over a pluggable extractor: what identifies an item, when a pass stops, and what a prompt is told."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import claim_key, replay_rounds
from .extract import Extractor

_text = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))


def source_key(text: Column, kind: Column, source: Column) -> Column:
    """What makes two claims of the third kind of pass one: proposition, type and source."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    return F.struct(_text(text).alias("text"), blank(kind).alias("type"), blank(source).alias("source_id"))


def _kept(rounds: DataFrame, identity: Column, least: int) -> DataFrame:
    return replay_rounds(rounds.withColumn("identity", F.to_json(identity)), least=least)


def nodes_pass(chunks: DataFrame, extractor: Extractor) -> DataFrame:
    """Nodes by exact name, the first of all chunks and rounds; a round that brings fewer than two new ones is a chunk's last."""
    rounds = extractor.rounds(chunks)
    return _kept(rounds, F.struct(F.col("item.name").alias("name")), 2)


def claims_pass(chunks: DataFrame, extractor: Extractor) -> DataFrame:
    """Claims by proposition, type, attestation, speaker and anonymous origin; stops as the nodes do."""
    i = F.col("item")
    return _kept(extractor.rounds(chunks), claim_key(i["content"], i["type"], i["attestation"], i["speaker"]), 2)


def sourced_claims_pass(chunks: DataFrame, extractor: Extractor) -> DataFrame:
    i = F.col("item")
    return _kept(extractor.rounds(chunks), source_key(i["content"], i["type"], i["source_id"]), 2)


def cast_pass(chunks: DataFrame, extractor: Extractor) -> DataFrame:
    """People and sources of a whole record; a round is the last that brings neither a new person nor a new source."""
    i = F.col("item")
    return _kept(extractor.rounds(chunks), F.struct(i["kind"].alias("kind"), i["name"].alias("name")), 1)


def accounts_pass(records: DataFrame, extractor: Extractor) -> DataFrame:
    """Accounts of a whole record by title, untitled ones left out; a round is the last that brings none."""
    rounds = extractor.rounds(records)
    titled = rounds.where(F.coalesce(F.trim("item.title"), F.lit("")) != "")
    silent = rounds.select("record_key", "chunk", "round", "complete").distinct()
    # a round of untitled accounts alone still is a round: it brings none
    marks = silent.join(titled, ["record_key", "chunk", "round"], "left_anti")
    rows = titled.withColumn("identity", F.trim("item.title")).unionByName(marks.select("record_key", "chunk", "round", "complete"), allowMissingColumns=True)
    return replay_rounds(rows.select(rounds.columns), least=1).where("identity is not null")


def record_line(title: Column, creators: Column, date: Column, source_type: Column) -> Column:
    """The line that tells a prompt which record it reads, and who "I" is in it."""
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    names = F.array_join(F.coalesce(creators, F.array().cast("array<string>")), ", ")
    named = F.when(filled(title), F.concat(F.lit('"'), title, F.lit('"'))).otherwise("an untitled record")
    line = F.concat(
        F.lit("SOURCE RECORD: "), named, F.when(filled(source_type), F.concat(F.lit(" ("), source_type, F.lit(")"))).otherwise(""), F.when(names != "", F.concat(F.lit(" by "), names)).otherwise(""),
        F.when(filled(date), F.concat(F.lit(" dated "), date)).otherwise(""), F.lit(".\n"),
    )
    first = F.when(names != "", F.concat(F.lit("First-person words in the text, and its author, mean "), names, F.lit(": use the name.\n"))).otherwise("")
    return F.concat(line, first, F.lit("\n"))


def directories(nodes: DataFrame, key: str = "record_key") -> DataFrame:
    """(key, directory): a record's nodes by type, a line each, for the prompt of a later pass."""
    lines = nodes.select(key, "node_type", "name").distinct().groupBy(key, "node_type").agg(F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("names"))
    lines = lines.groupBy(key).agg(F.array_sort(F.collect_list(F.concat("node_type", F.lit(": "), "names"))).alias("xs"))
    return lines.select(key, F.array_join("xs", "\n").alias("directory"))


def exclusions(found: DataFrame, key: str = "record_key") -> DataFrame:
    """(key, excluded): what a record's earlier rounds brought, in order, for the prompt of the next."""
    return found.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_set("identity")), lambda x: F.concat(F.lit("  - "), x)), "\n").alias("excluded"))


def first_json(raw: str | None) -> str | None:
    """The first JSON value of an answer, out of its code fence and whatever follows it; a wrapper's ``structured_output`` is unwrapped. None if there is none."""
    text = (raw or "").strip()
    if text.startswith("```"):
        text = text[3:].split("```", 1)[0]
        text = text.removeprefix("json")
    try:
        value, _ = json.JSONDecoder().raw_decode(text.lstrip())
    except ValueError:
        return None
    if isinstance(value, dict) and "structured_output" in value:
        value = value["structured_output"]
    return json.dumps(value, ensure_ascii=False)


def repaired(answers: DataFrame, raw: str = "raw") -> DataFrame:
    """The answers with ``doc``, their JSON, and ``issue``: malformed_json where there is none. A narrow map."""
    schema = answers.schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            docs = [first_json(x) for x in df[raw]]
            yield df.assign(doc=pd.Series(docs, df.index, "object"), issue=pd.Series([None if d is not None else "malformed_json" for d in docs], df.index, "object"))

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", doc string, issue string"
    return answers.mapInPandas(run, shape)
