"""Operator 1, token counts: count-only Viterbi for a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character of a word. For each end, dynamic programming
carries the best score and the number of pieces on that best path, and nothing to trace the path back with. Ties follow
the tokenizer exactly: pieces are tried from the longest, and a later one must score strictly more. A character that is no piece by itself
costs the lowest score less 10 and counts as its UTF-8 bytes (byte fallback).

The vocabulary is the pieces of a public SentencePiece file. That file ranks pieces and has no probabilities, so the scores are
set by rule, not trained: piece number r has ln(1 / (r + 2)), Zipf's law. Words are split at Unicode white space and begin with U+2581.

Control and byte pieces of the file (``<s>``, ``<0x0A>``) are ordinary strings here: a text that holds them literally matches them.

Defined cases: null, empty and blank texts have no tokens and score 0; a text of any length is counted whole, word by word; an empty table gives an
empty one; repeated rows and ids, null ids included, are counted each by itself; other columns are ignored.
The operator is a narrow map; each worker keeps a bounded cache of words.
"""

from __future__ import annotations

import math
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .scratch import narrow, slices
from .subwords import vocabulary_path

UNKNOWN_PENALTY, MARK = 10.0, "▁"
SCHEMA = "doc_id long, n_words long, n_tokens long, score double"
#: Unicode White_Space; Python's str.split also splits at U+001C..U+001F.
_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")


def zipf_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) in the order of the file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), -math.log(i + 2)) for i in range(model.get_piece_size())]


class Counter(dict):
    """word -> (tokens, score), computed once and kept; at most ``LIMIT`` words."""

    LIMIT = 400_000
    _shared: dict[str, Counter] = {}

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY

    @classmethod
    def shared(cls, name: str) -> Counter:
        if name not in cls._shared:
            cls._shared[name] = cls(zipf_vocabulary(name if os.sep in name else vocabulary_path(name)))
        return cls._shared[name]

    def viterbi(self, text: str) -> tuple[int, float]:
        n = len(text)
        best, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
        now, single = 0, True  # the end whose pieces are coming in, and whether its last character is one
        for end, (length, score) in self.automaton.iter(text):  # by end, from the longest piece
            end += 1
            while now < end:
                if not single:
                    self._unknown(text, now, best, count)
                now += 1
                single = False
            s = best[end - length] + score
            if s > best[end]:
                best[end], count[end] = s, count[end - length] + 1
            if length == 1:
                single = True
        while now <= n:
            if not single:
                self._unknown(text, now, best, count)
            now += 1
            single = False
        return count[n], best[n]

    def _unknown(self, text: str, end: int, best: list[float], count: list[int]) -> None:
        s = best[end - 1] + self.unknown
        if s > best[end]:
            best[end], count[end] = s, count[end - 1] + len(text[end - 1].encode("utf-8", "surrogatepass"))

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) >= self.LIMIT:
            self.clear()
        if MARK in word:  # the tokenizer splits before each mark, and adds none to a word that begins with one
            parts = re.split(f"(?={MARK})", word if word[0] == MARK else MARK + word)
            counts, scores = zip(*(self.viterbi(p) for p in parts if p), strict=True)
            got = sum(counts), math.fsum(scores)
        else:
            got = self.viterbi(MARK + word)
        self[word] = got
        return got

    def count(self, text: str) -> tuple[int, int, float]:
        """Words, tokens and the score of the best segmentation."""
        words = text.split() if not any(c in text for c in "\x1c\x1d\x1e\x1f") else [w for w in _SPACE.split(text) if w]
        if not words:
            return 0, 0, 0.0
        tokens, scores = zip(*map(self.__getitem__, words), strict=True)
        return len(words), sum(tokens), math.fsum(scores)


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per document: words, tokens, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.shared(vocabulary)
        for b in slices(batches):
            rows = [counter.count(t) for t in b.column(1).to_pylist()]
            words, tokens, scores = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64()), pa.array(scores, pa.float64())], names=["doc_id", "n_words", "n_tokens", "score"])

    return narrow(docs, "doc_id", "text").mapInArrow(run, SCHEMA)
