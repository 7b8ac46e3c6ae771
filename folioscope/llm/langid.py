"""Operator 8, language ID: word-first backoff.

A word that the model knows scores by its log frequency in each language. An unseen word falls back to character
n-grams: at each place the longest known n-gram, of ``MAX_GRAM`` characters down to one, scores with a penalty for each step down.

The model is a classifier fitted on about ``FIT_DOCS`` labelled documents of each language, chosen by a hash (all of them where there are fewer).
Every word and every n-gram of those documents is kept, so the broadcast is bounded by that parameter and no language crowds out another's
words. Every document is scored over its whole text, however long. A word is a run of letters as Unicode has them.

Defined cases: null texts and texts without a letter are ``und`` with score 0; so is everything if nothing is labelled.
Ties go to the language that sorts first. Repeated rows and ids, null ids included, are scored each by itself; an empty table gives an empty one;
other columns are ignored.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import ROWS_PER_BATCH, narrow, slices

FIT_DOCS, MAX_GRAM, STEP_DOWN, CACHE = 2_000, 4, 0.9, 200_000
#: Below this the pipeline's stage treats the language as unknown.
MIN_SCORE = 0.4
_WORD = re.compile(r"[^\W\d_]+")
#: Characters that ``re`` takes for parts of words though they are neither letters nor decimal digits, such as fractions.
_ODD = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
_ODD_LATIN = [c.encode("latin-1") for c in sorted(_ODD) if c < "\u0100"]
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def _odd(text: str) -> bool:
    """Whether a text has a character of ``_ODD``; quick for texts of Latin letters alone."""
    if text.isascii():
        return False
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return not _ODD.isdisjoint(text)
    return any(c in raw for c in _ODD_LATIN)


def words_in(text: str) -> list[str]:
    """Runs of letters of the lowered text."""
    text = text.lower()
    if _odd(text):
        text = "".join(" " if c in _ODD else c for c in text)
    return _WORD.findall(text)


def grams(word: str) -> Iterator[str]:
    padded = f"_{word}_"
    for n in range(1, MAX_GRAM + 1):
        for i in range(len(padded) - n + 1):
            yield padded[i : i + n]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (lang, kind, gram) of a task; kind 0 is a word, kind n an n-gram of n characters."""
    of_lang: dict[str, Counter] = {}
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            of_lang.setdefault(lang, Counter()).update(words_in(text))
    for lang, counter in of_lang.items():
        pieces = Counter()
        for word, c in counter.items():
            for g in grams(word):
                pieces[g] += c
        for kind, rows in ((None, pieces), (0, counter)):
            names = list(rows)
            kinds = [len(g) for g in names] if kind is None else [0] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names), pa.string()), pa.array(kinds, pa.int32()), pa.array(names, pa.string()), pa.array(list(rows.values()), pa.int64())], names=["lang", "kind", "gram", "c"])


class Model(dict):
    """Log frequencies of words and n-grams for each language. As a dict: word -> its row in ``scores``, at most about ``CACHE`` unseen ones."""

    def __init__(self, langs: list[str], words: dict[str, np.ndarray], grams_: list[dict[str, np.ndarray]]):
        super().__init__()
        self.langs = langs
        self.known = {w: k for k, w in enumerate(words)}
        empty = np.zeros((0, len(langs)))
        self.scores = np.array(list(words.values())) if words else empty
        #: n-gram -> its row, for each length; rows carry the penalty for stepping down
        self.grams: list[dict[str, int]] = [{} for _ in range(MAX_GRAM + 1)]
        rows: list[np.ndarray] = []
        for n, table in enumerate(grams_):
            for g, score in table.items():
                self.grams[n][g] = len(rows)
                rows.append(score * STEP_DOWN ** (MAX_GRAM - n))
        self.gram_scores = np.array(rows) if rows else empty
        self.pending: list[str] = []
        self.update(self.known)

    def __reduce__(self):
        return _restore, (self.langs, self.known, self.scores[: len(self.known)], self.grams, self.gram_scores)

    @classmethod
    def fit(cls, counts: pa.Table) -> Model:
        """From the counts (lang, kind, gram, c) of all words and n-grams, in any order."""
        langs = sorted(set(counts.column("lang").unique().to_pylist()))
        at = {x: i for i, x in enumerate(langs)}
        tables: list[dict[str, np.ndarray]] = []
        for kind in range(MAX_GRAM + 1):
            mine = counts.filter(pc.equal(counts.column("kind"), kind)).sort_by("gram")
            names = mine.column("gram").unique().to_pylist()
            row = {x: i for i, x in enumerate(names)}
            c = np.zeros((len(names), len(langs)))
            for name, lang, n in zip(mine.column("gram").to_pylist(), mine.column("lang").to_pylist(), mine.column("c").to_pylist(), strict=True):
                c[row[name], at[lang]] += n
            tables.append(dict(zip(names, np.log((c + 0.1) / (c.sum(0) + 0.1 * (len(names) + 1))), strict=True)))
        return cls(langs, tables[0], [{}, *tables[1:]])

    def __missing__(self, word: str) -> int:
        self[word] = row = len(self)
        self.pending.append(word)
        return row

    def backoff(self, word: str) -> list[int]:
        """The row of the longest known n-gram at each place of the word; places without any are left out."""
        padded, out = f"_{word}_", []
        longest_first = [(k, self.grams[k]) for k in range(MAX_GRAM, 0, -1)]
        for i in range(len(padded)):
            for k, table in longest_first:
                row = table.get(padded[i : i + k]) if i + k <= len(padded) else None
                if row is not None:
                    out.append(row)
                    break
        return out

    def _settle(self) -> None:
        """Rows for the words met first in this batch: the mean score of their n-grams."""
        found = [self.backoff(w) for w in self.pending]
        size = np.array([len(f) for f in found])
        rows = np.zeros((len(found), len(self.langs)))
        some = size > 0
        if some.any():
            flat = np.array([x for f in found for x in f])
            rows[some] = np.add.reduceat(self.gram_scores[flat], (np.cumsum(size) - size)[some]) / size[some][:, None]
        self.scores = np.concatenate([self.scores, rows])
        self.pending = []

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        if len(self) > len(self.known) + CACHE:
            self.clear()
            self.update(self.known)
            self.scores = self.scores[: len(self.known)]
        split = [words_in(t) if self.langs else [] for t in texts]
        size = np.array([len(s) for s in split])
        rows = np.fromiter(map(self.__getitem__, (w for s in split for w in s)), np.int64, int(size.sum()))
        if self.pending:
            self._settle()
        out = [("und", 0.0)] * len(texts)
        some = np.flatnonzero(size)
        if len(some):
            total = np.add.reduceat(self.scores[rows], (np.cumsum(size) - size)[some])
            # words of one text depend on each other, so evidence counts as the root of their number
            p = np.exp((total - total.max(1, keepdims=True)) / np.sqrt(size[some])[:, None])
            p /= p.sum(1, keepdims=True)
            for k, best, q in zip(some.tolist(), total.argmax(1).tolist(), p, strict=True):
                out[k] = (self.langs[best], float(q[best]))
        return out


def _restore(langs, known, scores, grams_, gram_scores) -> Model:
    model = Model(langs, {}, [{} for _ in range(MAX_GRAM + 1)])
    model.known, model.scores, model.grams, model.gram_scores = known, scores, grams_, gram_scores
    model.update(known)
    return model


def fit(train: DataFrame) -> Model:
    """``train`` has lang and text; only rows with a language teach."""
    texts = train.where(F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)).alias("at"))
    sizes = {r.lang: r["count"] for r in texts.groupBy("lang").count().collect()}  # one row for each language
    chosen = F.lit(False)
    for lang, n in sizes.items():
        chosen = chosen | ((F.col("lang") == lang) & (F.col("at") < min(1 << 40, int(FIT_DOCS / n * (1 << 40)))))
    counts = texts.where(chosen).mapInArrow(_count, "lang string, kind int, gram string, c long")
    return Model.fit(counts.groupBy("lang", "kind", "gram").agg(F.sum("c").alias("c")).toArrow())


def held_out(doc_id: str, modulus: int, rest: int):
    """Whether a document is kept from training; one without an id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus)) == rest, F.lit(False))


def language_id(docs: DataFrame) -> DataFrame:
    """One row per document: predicted language and its posterior."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = spark.sparkContext.broadcast(fit(base.where(~held_out("doc_id", 3, 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in slices(batches):
            got = m.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    scored = narrow(docs, "doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def keep_recognised(docs: DataFrame) -> DataFrame:
    """The documents with a recognised language, ``lang`` filled in where it is null; same columns."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = spark.sparkContext.broadcast(fit(base.where(~held_out("doc_id", 3, 1))))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    columns = docs.columns
    rest = [c for c in columns if c != "text"]
    ready = docs.select(F.lit(0).cast("long").alias("key"), "text", F.struct(*rest).alias("row"))  # any names go in the struct; the text travels once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in slices(batches):
            got = m.predict(b.column(1).fill_null("").to_pylist())
            keep = pa.array([p != "und" and s >= MIN_SCORE for p, s in got], pa.bool_())
            out = dict(zip(rest, b.column(2).flatten(), strict=True)) | {"text": b.column(1)}
            out["lang"] = pa.array([x if x is not None else p for x, (p, _) in zip(out["lang"].to_pylist(), got, strict=True)], out["lang"].type)
            yield pa.RecordBatch.from_arrays([out[c] for c in columns], names=columns).filter(keep)

    return ready.mapInArrow(run, docs.schema)
