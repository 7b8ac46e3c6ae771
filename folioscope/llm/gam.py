"""Quality scores by a generalised additive model with pairwise interactions.

Each feature of a text falls into one of at most ``BINS`` bins, cut at the quantiles of the training rows. The model is one table of log odds for each feature
and, for the pairs of features that explain most of what is left, one table over coarser bins of both. Boosting goes round the features in turn: a shallow
tree on one feature (two levels of cuts along its bins), or on a pair (a cut in each), is fitted to the gradient and added, shrunk, to that feature's table.
A score is then a sum of looked-up numbers, done for a whole batch at once.

The features are shares and lengths of characters, words, lines and their repetition; labels, language, source and ids are none of them.

The model is fitted on the driver on at most about ``FIT_ROWS`` labelled documents, drawn by hash; every document is scored, on the whole text. A label
counts if it is 0 or 1; several for one document count as their mean, a tie as 1. Null texts are scored as empty ones. Without any label the score is 0.5; rows that
repeat get a score each, null ids stay null and are never held out. Of other columns none is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .langid import held_out
from .scratch import narrow, slices
from .wordhash import SPACE_FOLDED, utf8, windows, words

#: Labelled documents that the fit draws, and the score from which a document is predicted to be good.
FIT_ROWS, THRESHOLD = 20_000, 0.3
#: Bins of a feature and of each side of a pair; rounds, shrinkage, pairs; and what keeps leaves from being rash.
BINS, PAIR_BINS, ROUNDS, PAIR_ROUNDS, RATE, PAIRS, RIDGE, LEAST = 64, 12, 120, 60, 0.15, 8, 1.0, 2.0

FEATURES = (
    "words", "word_bytes", "distinct_words", "distinct_trigrams", "repeated_words", "one_letter", "lines", "line_words", "distinct_lines", "line_ends", "lower", "upper", "digits", "spaces", "stops", "commas", "marks",
    "bars", "symbols", "beyond_ascii", "capitalised", "capitals", "sentence_words", "digit_words",
)


def _classes() -> np.ndarray:
    """A class for each byte: 0 others, 1 lower, 2 upper, 3 digits, 4 spaces, 5 line breaks, 6 stops, 7 commas, 8 marks, 9 bars, 10 symbols, 11 first and 12 later bytes of other characters."""
    out = np.zeros(256, np.uint8)
    for k, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\v\f", "\n", ".!?", ",;:", "'\"()[]-`", "|<>{}", "#*$%&@^~=+_\\/"), 1):
        out[np.frombuffer(chars.encode(), np.uint8)] = k
    out[0xC0:], out[0x80:0xC0] = 11, 12
    return out


CLASSES = _classes()
_LINES = np.where(np.arange(256) == 10, 0, np.maximum(np.arange(256), 1)).astype(np.uint8)


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Distinct values of each owner."""
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[fresh], minlength=n)


def features(column: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` for each text."""
    raw, offsets = utf8(column)
    n = len(column)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(owner * 16 + CLASSES[raw], minlength=n * 16).reshape(n, 16).astype(np.float64)
    w, lines = words(column, SPACE_FOLDED), words(column, _LINES)
    n_words, n_lines = np.diff(w.first), np.diff(lines.first)
    of = w.doc_of_word()
    three = windows(w.hashes, 3)
    inside = of[: len(three)] == of[2:] if len(three) else np.zeros(0, bool)
    three, three_of = three[inside], of[: len(inside)][inside]
    same = (w.hashes[1:] == w.hashes[:-1]) & (of[1:] == of[:-1])
    head = CLASSES[raw[w.begin]] if len(of) else np.zeros(0, np.uint8)
    second = CLASSES[raw[np.minimum(w.begin + 1, len(raw) - 1)]] if len(of) else head
    long = w.end - w.begin
    per_word = lambda mask: np.bincount(of[mask], minlength=n)
    stop_ends = np.isin(CLASSES[raw[lines.end - 1]], (6, 7, 8)) if len(lines.end) else np.zeros(0, bool)
    chars, some_words, some_lines = np.maximum(counts.sum(1) - counts[:, 12], 1), np.maximum(n_words, 1), np.maximum(n_lines, 1)
    letters = np.maximum(counts[:, 1] + counts[:, 2] + counts[:, 11], 1)
    stops = counts[:, 6]
    columns = [
        np.log1p(n_words), np.bincount(of, weights=long, minlength=n) / some_words, _distinct(w.hashes, of, n) / some_words, _distinct(three, three_of, n) / np.maximum(np.bincount(three_of, minlength=n), 1),
        np.bincount(of[1:][same], minlength=n) / some_words, per_word(long == 1) / some_words, np.log1p(n_lines), np.log1p(n_words / some_lines), _distinct(lines.hashes, lines.doc_of_word(), n) / some_lines,
        np.bincount(lines.doc_of_word()[stop_ends], minlength=n) / some_lines, counts[:, 1] / letters, counts[:, 2] / letters, counts[:, 3] / chars, (counts[:, 4] + counts[:, 5]) / chars, stops / some_words, counts[:, 7] / some_words,
        counts[:, 8] / some_words, counts[:, 9] / some_words, counts[:, 10] / some_words, counts[:, 11] / letters, per_word(head == 2) / some_words, per_word((head == 2) & (second == 2)) / some_words,
        np.log1p(n_words / np.maximum(stops, 1)), per_word(head == 3) / some_words,
    ]
    return np.stack([np.asarray(c, np.float64) for c in columns], axis=1)


@dataclass
class Model:
    """Log odds: an intercept, a table for each feature, and tables for pairs of features over coarser bins."""

    cuts: list[np.ndarray]
    coarse: list[np.ndarray]
    tables: np.ndarray  # feature x bin
    intercept: float = 0.0
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for f, cuts in enumerate(self.cuts):
            out += self.tables[f][np.searchsorted(cuts, x[:, f], side="right")]
        for (f, g), table in zip(self.pairs, self.pair_tables, strict=True):
            out += table[np.searchsorted(self.coarse[f], x[:, f], side="right"), np.searchsorted(self.coarse[g], x[:, g], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(x), -500, 500)))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    """Borders between bins of about equal weight; equal values are never parted."""
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="nearest")) if len(x) else np.zeros(0)


def _leaf(g, h):
    return g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, bins before the cut) of the best cut of a stretch of bins; no gain if there is none."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, 0
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g * _leaf(left_g, left_h) + right_g * _leaf(right_g, right_h) - g.sum() * _leaf(g.sum(), h.sum())
    gain[(left_h < LEAST) | (right_h < LEAST)] = 0.0
    best = int(gain.argmax())
    return float(gain[best]), best + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Two levels of cuts along the bins of one feature: what each bin adds."""
    ends = [0, len(g)]
    for _ in range(2):
        more = []
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            gain, at = _best_cut(g[a:b], h[a:b])
            if gain > 1e-9:
                more.append(a + at)
        ends = sorted(ends + more)
    out = np.zeros(len(g))
    if len(ends) > 2:
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, what each cell adds) of the best pair of cuts, one along each side of a table."""
    gs, hs = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)

    def parts(s):
        low, left, top = s[:-1, :-1], s[:-1, -1:], s[-1:, :-1]
        return low, left - low, top - low, s[-1, -1] - left - top + low

    quarters = list(zip(parts(gs), parts(hs), strict=True))
    gain = sum(q * _leaf(q, w) for q, w in quarters) - gs[-1, -1] * _leaf(gs[-1, -1], hs[-1, -1])
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.zeros(g.shape)
    for k, (q, w) in enumerate(quarters):
        rows, columns = (slice(0, i + 1) if k in (0, 1) else slice(i + 1, None)), (slice(0, j + 1) if k in (0, 2) else slice(j + 1, None))
        if w[i, j] >= LEAST:
            out[rows, columns] = _leaf(q[i, j], w[i, j])
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting: all features in turn, round after round; then the best pairs on what is left."""
    n, n_features = x.shape
    prior = (y.sum() + 1.0) / (n + 2.0)
    cuts, coarse = ([_cuts(x[:, f], b) for f in range(n_features)] for b in (BINS, PAIR_BINS))
    model = Model(cuts, coarse, np.zeros((n_features, BINS)), float(np.log(prior / (1 - prior))))
    if not n or y.min() == y.max():
        return model
    bins = [np.searchsorted(cuts[f], x[:, f], side="right") for f in range(n_features)]
    odds = np.full(n, model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-odds))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(n_features):
            g, h = slopes()
            size = len(cuts[f]) + 1
            step = RATE * _tree(np.bincount(bins[f], g, size), np.bincount(bins[f], h, size))
            model.tables[f, :size] += step
            odds += step[bins[f]]
    wide = [np.searchsorted(coarse[f], x[:, f], side="right") for f in range(n_features)]
    shape = lambda a, b: (len(coarse[a]) + 1, len(coarse[b]) + 1)
    cell = {(a, b): wide[a] * shape(a, b)[1] + wide[b] for a in range(n_features) for b in range(a)}

    def table(pair, weights) -> np.ndarray:
        rows, columns = shape(*pair)
        return np.bincount(cell[pair], weights, rows * columns).reshape(rows, columns)

    g, h = slopes()
    ranked = sorted(((_quadrants(table(pair, g), table(pair, h))[0], pair) for pair in cell), reverse=True)
    model.pairs = [pair for gain, pair in ranked[:PAIRS] if gain > 1e-9]
    model.pair_tables = [np.zeros(shape(*pair)) for pair in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, pair in enumerate(model.pairs):
            g, h = slopes()
            step = RATE * _quadrants(table(pair, g), table(pair, h))[1]
            model.pair_tables[k] += step
            odds += step.ravel()[cell[pair]]
    # tables mean nothing by themselves unless each is centred on the training rows
    for f in range(n_features):
        size, mean = len(cuts[f]) + 1, float(model.tables[f][bins[f]].mean())
        model.tables[f, :size] -= mean
        model.intercept += mean
    for k, pair in enumerate(model.pairs):
        mean = float(model.pair_tables[k].ravel()[cell[pair]].mean())
        model.pair_tables[k] -= mean
        model.intercept += mean
    return model


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        x = features(b.column(1))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "x"])


def training_rows(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of about ``FIT_ROWS`` labelled documents that are not held out."""
    good = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q")).where("doc_id is not null and q in (0, 1)").where(~held_out("doc_id", 5, 0))
    one = good.groupBy("doc_id").agg((F.avg("q") >= 0.5).cast("int").alias("q"))
    n = one.count()
    at = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    chosen = one.where(at < min(1 << 40, int(FIT_ROWS / max(n, 1) * (1 << 40))))  # about FIT_ROWS narrow rows, so safe to broadcast
    rows = narrow(docs, "doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(_featured, "doc_id long, x array<double>")
    # several documents of one id count as one, whatever their order
    got = rows.groupBy("doc_id").agg(F.min("x").alias("x")).join(F.broadcast(chosen), "doc_id").orderBy("doc_id").toArrow()
    x = np.array(got.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return x, got.column("q").to_numpy().astype(np.float64)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document."""
    model = docs.sparkSession.sparkContext.broadcast(fit(*training_rows(docs, labels)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            score = model.value.score(features(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "score", "predicted"])

    scored = narrow(docs, "doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")
