"""Splitting texts into chunks whose concatenation is the text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from .batches import pieces

MOST, LEAST_HARD, LEAST_CHUNK = 150_000, 20_000, 50_000
# In order of preference: a page marker, a heading, a blank line, a line break; the split comes after the match's first newline.
_BOUNDARIES = (re.compile(r"\n(?=<!-- page|file_page: )"), re.compile(r"\n(?=## )"), re.compile(r"\n\n"), re.compile(r"\n"))
_CHAPTER = re.compile(r"\n(?=<!-- chapter: )")


def split_point(text: str, low: int, high: int) -> int:
    """The latest boundary of the best kind in [low, high), or high."""
    for kind in _BOUNDARIES:
        last = None
        for last in kind.finditer(text, low, high):
            pass
        if last is not None and last.start() > 0:
            return last.end()
    return high


def windows(text: str, most: int, least: int) -> list[tuple[int, int]]:
    spans, at = [], 0
    while len(text) - at > most:
        cut = split_point(text, at + min(least, most - 1), at + most)
        spans.append((at, cut))
        at = cut
    spans.append((at, len(text)))
    return spans


def chapters(text: str) -> list[tuple[int, int]]:
    cuts = [0, *(m.end() for m in _CHAPTER.finditer(text)), len(text)]
    return list(zip(cuts, cuts[1:], strict=False)) if len(cuts) > 2 else []


def build(text: str, most: int) -> list[tuple[int, int]]:
    """By chapter where there are two, then by windows of a hard size."""
    hard = min(MOST, max(most, LEAST_HARD))
    parts = chapters(text) or [(0, len(text))]
    return [(s + a, s + b) for s, e in parts for a, b in windows(text[s:e], hard, min(LEAST_CHUNK, hard))]


def chunk_rows(docs: DataFrame, key: str, text: str, most: int, least: int | None = None) -> DataFrame:
    """(key, idx, start, end, text). A narrow map: one row's text at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (piece for batch in batches for piece in pieces(batch, 1)):
            rows = []
            for k, t in enumerate(b.column(1).to_pylist()):
                t = t or ""
                spans = build(t, most) if least is None else windows(t, most, least)
                rows += [(k, i, s, e, t[s:e]) for i, (s, e) in enumerate(spans)]
            row, *more = zip(*rows, strict=True)
            places = [pa.array(x, kind) for x, kind in zip(more, (pa.int32(), pa.int32(), pa.int32(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), *places], names=[key, "idx", "start", "end", "text"])

    return docs.select(key, text).mapInArrow(run, f"{key} {dict(docs.dtypes)[key]}, idx int, start int, end int, text string")


class Chunks:
    """The table function ``chunks(text, most, least)``: idx, start, end and text of each window; without ``least``, by chapter first. Null is the empty text."""

    def eval(self, text: str, most: int, least: int | None = None):
        text = text or ""
        for i, (s, e) in enumerate(build(text, most) if least is None else windows(text, most, least)):
            yield i, s, e, text[s:e]


def register(spark: SparkSession) -> None:
    """Makes ``chunks`` known to SQL; rows travel in Arrow batches."""
    spark.udtf.register("chunks", udtf(Chunks, returnType="idx int, start int, end int, text string", useArrow=True))


def chunked(docs: DataFrame, key: str, text: str, most: int, least: int | None = None) -> DataFrame:
    """(key, idx, start, end, text) by the table function, joined laterally: a narrow plan, one row's text at a time."""
    spark = docs.sparkSession
    register(spark)
    docs = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    limit = "null" if least is None else int(least)
    return spark.sql(f"SELECT d._key, c.* FROM {{docs}} d, LATERAL chunks(d._text, {int(most)}, {limit}) c", docs=docs).withColumnRenamed("_key", key)
