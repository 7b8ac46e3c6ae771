"""Reading records: front matter, page breaks, annotations, preparation, highlights and context edges."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import iso_date
from ..schemas import RECORD

#: Version of :func:`materialise`; a change of its result raises it.
PREP_VERSION = 7
_KEYS = ("title", "creators", "source_type", "reference")
_ANNOTATION_KEYS = {"file_page", "printed_page", "chapter", "speaker", "image"}
MOST_ANNOTATION_LINES = 40
_LOADER = getattr(yaml, "CSafeLoader", yaml.SafeLoader)


def _mapping(text: str) -> dict | None:
    try:
        got = yaml.load(text, _LOADER)
    except yaml.YAMLError:
        return None
    return got if isinstance(got, dict) else None


def front_matter(text: str) -> tuple[dict, str]:
    """The mapping between the first two ``---`` lines, and the rest. A text without one has none."""
    if not text.startswith("---\n"):
        return {}, text
    end = text.find("\n---\n", 3)
    if end < 0:
        return {}, text
    head = _mapping(text[4:end])
    return (head, text[end + 5 :]) if head is not None else ({}, text)


def strip_annotations(body: str) -> tuple[str, list[dict]]:
    """The body without fenced annotation blocks, and a page break for each ``file_page``, at its offset in what is left.

    A fenced block is an annotation only if it is short, parses as a mapping and has a key that annotations have.
    """
    lines, out, pages, i, length = body.split("\n"), [], [], 0, 0
    while i < len(lines):
        if lines[i] == "---":
            end = next((k for k in range(i + 1, min(len(lines), i + 2 + MOST_ANNOTATION_LINES)) if lines[k] == "---"), None)
            found = _mapping("\n".join(lines[i + 1 : end])) if end else None
            if found and _ANNOTATION_KEYS & set(found):
                if isinstance(found.get("file_page"), int) and not isinstance(found["file_page"], bool):
                    pages.append({"file_page": found["file_page"], "offset": length})
                i = end + 1
                continue
        out.append(lines[i])
        length += len(lines[i]) + 1
        i += 1
    return "\n".join(out), pages


def parse(text: str) -> dict:
    head, body = front_matter(text)
    body, pages = strip_annotations(body)
    creators = head.get("creators", head.get("authors")) or []
    creators = [creators] if isinstance(creators, str) else [str(c) for c in creators]
    known = {*_KEYS, "authors", "date", "date_published", "schema"}
    as_text = lambda v: v if v is None or isinstance(v, str) else str(v)
    return {
        "title": as_text(head.get("title")), "date": as_text(head.get("date_published", head.get("date"))), "creators": creators, "source_type": as_text(head.get("source_type")),
        "reference": as_text(head.get("reference")), "schema_version": as_text(head.get("schema")), "metadata": {str(k): json.dumps(v, default=str, sort_keys=True) for k, v in head.items() if k not in known}, "body": body, "pages": pages,
    }


def read_records(texts: DataFrame, key: str = "record_key", text: str = "value") -> DataFrame:
    """Parsed rows of (key, whole text); a narrow map."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            yield pd.DataFrame([{"record_key": k} | parse(t or "") for k, t in zip(df[key], df[text], strict=True)], columns=[c.strip().split(" ")[0] for c in _top_level(RECORD)])

    parsed = texts.select(key, text).mapInPandas(run, RECORD)
    return parsed.withColumn("date", iso_date(F.col("date")))


def _top_level(ddl: str) -> list[str]:
    out, depth, at = [], 0, 0
    for i, c in enumerate(ddl):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(ddl[at:i])
            at = i + 1
    return [*out, ddl[at:]]


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Records of a folder of text files, keyed by file name without its extension."""
    files = spark.read.text(path, wholetext=True).withColumn("record_key", F.regexp_extract(F.input_file_name(), "([^/]+?)(?:\\.[A-Za-z]+)?$", 1))
    return read_records(files)


# Preparation, our own definition: what goes, in this order.
_IRRELEVANT = "(?s)<!-- irrelevant: start -->.*?(?:<!-- irrelevant: end -->|\\z)"
_OVERLAY = "\\{\\{(?:highlight-(?:start|end|context)|overlay)[^}]*\\}\\}"
_WORD_TIME = "\\{\\{t:[0-9.]+\\}\\}"
_IMAGE = "(?s)<!-- image:.*?-->"


def strip_word_timestamps(body: Column) -> Column:
    return F.regexp_replace(body, _WORD_TIME, "")


def strip_overlay_markers(body: Column) -> Column:
    return F.regexp_replace(body, _OVERLAY, "")


def materialise(body: Column) -> Column:
    """The text that is digested: idempotent; speaker comments and line timestamps stay."""
    return F.regexp_replace(F.regexp_replace(strip_word_timestamps(strip_overlay_markers(body)), _IRRELEVANT, ""), _IMAGE, "")


def prepared(records: DataFrame) -> DataFrame:
    text = materialise(F.col("body"))
    return records.withColumn("pre_text", text).withColumn("pre_sha", F.sha2("pre_text", 256)).withColumn("prep_version", F.lit(PREP_VERSION))


_MARK = re.compile(r"\{\{highlight-(start|end): *([^}\s]+) *\}\}")


def highlights_of(body: str) -> list[dict]:
    """Highlights in order of their first part: {id, parts[{start, end, text}], text}, offsets in the body without any marker.

    An id may have several parts; a start without an end closes at the end of the body; an end without a start is dropped.
    """
    parts: dict[str, list[tuple[int, int]]] = {}
    open_at: dict[str, int] = {}
    plain, at, length = [], 0, 0
    for m in re.finditer(r"\{\{[^}]*\}\}", body):
        plain.append(body[at : m.start()])
        length += m.start() - at
        at = m.end()
        if mark := _MARK.fullmatch(m[0]):
            if mark[1] == "start":
                open_at.setdefault(mark[2], length)
            elif mark[2] in open_at:
                parts.setdefault(mark[2], []).append((open_at.pop(mark[2]), length))
    plain.append(body[at:])
    text = "".join(plain)
    for k, s in open_at.items():
        parts.setdefault(k, []).append((s, len(text)))
    out = [{"id": k, "parts": [{"start": s, "end": e, "text": text[s:e]} for s, e in sorted(v)]} for k, v in parts.items()]
    for h in out:
        h["text"] = " [...] ".join(p["text"] for p in h["parts"])
    return sorted(out, key=lambda h: (h["parts"][0]["start"], h["id"]))


def highlights(records: DataFrame, key: str = "record_key", body: str = "body") -> DataFrame:
    """(key, id, part, start, end, text) rows."""
    kind = "array<struct<id:string,parts:array<struct<start:int,end:int,text:string>>,text:string>>"

    @F.pandas_udf(kind)
    def find(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda b: highlights_of(b or ""))

    rows = records.select(key, F.explode(find(body)).alias("h"))
    return rows.select(key, F.col("h.id").alias("id"), F.posexplode("h.parts").alias("part", "p")).select(key, "id", "part", "p.start", "p.end", "p.text")


def context_edges(records: DataFrame, key: str = "record_key", body: str = "body") -> DataFrame:
    """(key, dependent, ancestor) of ``{{highlight-context: [a, b, …]}}``; lists of one say nothing."""
    lists = records.select(key, F.explode(F.regexp_extract_all(body, F.lit("\\{\\{highlight-context: *\\[([^\\]]*)\\] *\\}\\}"), F.lit(1))).alias("l"))
    ids = lists.select(key, F.transform(F.split("l", ","), lambda x: F.trim(x)).alias("ids")).where(F.size("ids") >= 2)
    return ids.select(key, F.element_at("ids", 1).alias("dependent"), F.explode(F.slice("ids", F.lit(2), F.greatest(F.size("ids") - 1, F.lit(0)))).alias("ancestor")).distinct()


def transcript(records: DataFrame, key: str = "record_key", body: str = "body") -> DataFrame:
    """(key, line, at, speaker, text): the speaker comment carries forward to the timestamped lines after it."""
    from pyspark.sql import Window

    from ..functions.codes import parse_timecode

    lines = records.select(key, F.posexplode(F.split(body, "\n")).alias("line", "l"))
    speaker = F.nullif(F.regexp_extract("l", "^<!-- speaker: (.*?) -->", 1), F.lit(""))
    said = lines.withColumn("speaker", F.last(speaker, ignorenulls=True).over(Window.partitionBy(key).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)))
    stamp = "^([0-9]+:[0-9]{2}:[0-9]{2}(?:\\.[0-9]+)?) (.*)$"
    return said.where(F.col("l").rlike(stamp)).select(key, "line", parse_timecode(F.regexp_extract("l", stamp, 1)).alias("at"), "speaker", F.regexp_extract("l", stamp, 2).alias("text"))
