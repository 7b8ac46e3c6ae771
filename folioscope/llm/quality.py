"""Operator 4, quality rules: line-first cleaning.

Each line with a word is judged by itself and by how often its text repeats it:

* punctuation: a line without an end mark that is shorter than ``SHORT`` words, or that has more than ``RUN_ON`` words for each mark; a line of
  ``CHOPPED`` words or more of which every second one ends a sentence.
* navigation: separators between short labels; a line of at most ``MENU_WORDS`` words that the text holds ``MENU_TIMES`` times or more.
* boilerplate: licence and site phrases in four languages, shouting, symbol noise.

Failing lines are removed, whole lines at a time; a document is then rejected if it lost more than ``MAX_LOSS_PERCENT`` of its words, or by the
base rule (fewer than 20 words, or more than 30 % of its words in 8-word windows that occur twice).

Defined cases: null and empty texts have no words, fail the base rule and have the empty clean text; a text of one line, however long, is judged
as one line; an empty table gives an empty one; there are no ties: a limit that is just met is no failure; repeated rows and ids, null ids
included, are judged each by itself; other columns are ignored. The operator is a narrow map: no shuffle, one document in memory besides its
Arrow batch.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import ROWS_PER_BATCH, narrow, slices
from .wordhash import SPACE_EXACT, utf8, windows, words

MIN_WORDS, MAX_REPEAT_PERCENT, MAX_LOSS_PERCENT, WINDOW = 20, 30, 40, 8

SHORT, RUN_ON, CHOPPED, MENU_WORDS, MENU_TIMES = 4, 25, 16, 8, 3

# Phrases that mark a short line as boilerplate.
BOILERPLATE = (
    "all rights reserved",
    "licensed under",
    "released under the",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "use cookies",
    "enable javascript",
    "subscribe to our",
    "sign up for",
    "click here",
    "copyright (c)",
    "©",
    "tous droits réservés",
    "conditions d'utilisation",
    "politique de confidentialité",
    "utilisons des cookies",
    "cliquez ici",
    "alle rechte vorbehalten",
    "nutzungsbedingungen",
    "datenschutzerklärung",
    "verwenden cookies",
    "klicken sie hier",
    "todos los derechos reservados",
    "términos de uso",
    "política de privacidad",
    "usamos cookies",
    "haga clic aquí",
)
#: A boilerplate phrase condemns a line of at most so many words.
BOILERPLATE_WORDS = 25
SYMBOLS = re.compile(r"[#*$%&|<>]")
_SYMBOL_BYTES = np.isin(np.arange(256), list(b"#*$%&|<>"))
_TERMINAL = tuple(".!?…\"'”’»):;")
_SPACE = " \t\n\r\x0b\x0c"
_LINE_MARK = re.compile(r"[|»•›>]")
_LOUD = re.compile(r"!!|[#*$%&]{2,}")
_PAUSE = re.compile(r"[.!?…,;:]")
_SENTENCE_END = re.compile(r"[.!?…][\"'”’»)]*[ \t\n\r\x0b\x0c]")
_PHRASE = re.compile("|".join(map(re.escape, BOILERPLATE)))

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_lines_removed long, words_removed long, clean_text string"
)


def line_failure(line: str, n_words: int, times: int = 1) -> str | None:
    """Why a line goes, or None. ``times`` is how often its text holds it."""
    marks = len(_LINE_MARK.findall(line))
    if marks >= 1 and marks * 6 >= n_words or times >= MENU_TIMES and n_words <= MENU_WORDS:
        return "navigation"
    if len(_LOUD.findall(line)) * 2 > n_words or n_words <= BOILERPLATE_WORDS and _PHRASE.search(line.lower()):
        return "boilerplate"
    if not line.rstrip(_SPACE).endswith(_TERMINAL) and (n_words < SHORT or n_words > RUN_ON and n_words > RUN_ON * len(_PAUSE.findall(line))):
        return "punctuation"
    if n_words >= CHOPPED and 2 * len(_SENTENCE_END.findall(line + " ")) > n_words:
        return "punctuation"
    return None


def clean(text: str) -> tuple[str, int, int, int, int]:
    """The text without failing lines, its lines with words, lines removed, words removed, and lines with words that equal an earlier one."""
    lines = text.split("\n")
    times = Counter(lines)
    kept, n_lines, removed, lost, distinct = [], 0, 0, 0, set()
    for line in lines:
        n = len(line.encode("utf-8", "surrogatepass").split())
        if n == 0:
            kept.append(line)
            continue
        n_lines += 1
        distinct.add(line)
        if line_failure(line, n, times[line]):
            removed += 1
            lost += n
        else:
            kept.append(line)
    return ("\n".join(kept) if removed else text), n_lines, removed, lost, n_lines - len(distinct)


def _repeat_words(hashes: np.ndarray, first: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Words of each document inside an 8-word window that the document holds twice or more."""
    n_docs = len(first) - 1
    w = windows(hashes, WINDOW)
    if not len(w):
        return np.zeros(n_docs, np.int64)
    at = np.flatnonzero(doc[: len(w)] == doc[WINDOW - 1 :])
    w, of = w[at], doc[at]
    order = np.lexsort((w, of))
    same = (w[order][1:] == w[order][:-1]) & (of[order][1:] == of[order][:-1])
    twice = np.zeros(len(w), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    delta = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(delta, at[twice], 1)
    np.add.at(delta, at[twice] + WINDOW, -1)
    covered = np.cumsum(delta[:-1]) > 0
    return np.bincount(doc[covered], minlength=n_docs)


def assess(batch: pa.RecordBatch) -> pa.RecordBatch:
    """All columns of SCHEMA for a batch of (doc_id, text)."""
    column = batch.column(1)
    raw, offsets = utf8(column)
    w = words(column, SPACE_EXACT)
    n_words = np.diff(w.first)

    def per_doc(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    lead = (raw & 0xC0) != 0x80
    word_chars = per_doc(lead & (w.data != 0))
    symbols = per_doc(_SYMBOL_BYTES[raw])
    repeat = _repeat_words(w.hashes, w.first, w.doc_of_word())
    base_failed = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words)
    texts = column.to_pylist()
    cleaned = [clean(t) for t in texts]
    lost = np.array([c[3] for c in cleaned], np.int64)
    kept = ~base_failed & (100 * lost <= MAX_LOSS_PERCENT * n_words)
    ints = lambda x: pa.array(np.asarray(x, np.int64))
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0), ints(n_words), ints(word_chars), ints(symbols), ints([c[4] for c in cleaned]), ints(repeat),
            pa.array(base_failed), pa.array(kept), ints([c[1] for c in cleaned]), ints([c[2] for c in cleaned]), ints(lost), pa.array([c[0] for c in cleaned], pa.string()),
        ],
        names=[c.split()[0] for c in SCHEMA.split(", ")],
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: base figures, verdict, and the text that the line rules leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield assess(b)

    return narrow(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def keep_clean(docs: DataFrame) -> DataFrame:
    """The documents that pass, without their failing lines; same columns, ``n_chars`` of the new text.

    Nothing is shuffled: the row travels through the map as one struct beside the text, so other columns may have any names.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    columns, types = docs.columns, dict(docs.dtypes)
    rest = [c for c in columns if c != "text"]
    ready = docs.select(F.lit(0).cast("long").alias("key"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.struct(*rest).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            r = assess(b.select([0, 1]))
            by_name = dict(zip(rest, b.column(2).flatten(), strict=True)) | {"text": r.column("clean_text")}
            yield pa.RecordBatch.from_arrays([by_name[c] for c in columns], names=columns).filter(r.column("kept"))

    out = ready.mapInArrow(run, docs.schema)
    if "n_chars" in types:
        out = out.withColumn("n_chars", F.length("text").cast(types["n_chars"])).select(*columns)
    return out
