"""Vectorised word and shingle hashing over whole Arrow batches of texts.

A batch's UTF-8 bytes are classified through a 256-entry table (0 separates words, any other value is the
folded byte), and each word gets a 64-bit hash from prefix sums of a polynomial. Shingle hashes mix the word
hashes, so nothing is done per word in Python. Two different words share a 64-bit value with a chance of
about 2^-64 a pair.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for the next batch."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        have = np.full(size, base & (2**64 - 1), dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ascii_space_table(fold: bool) -> np.ndarray:
    """Words are runs of anything but 0x20 and 0x09-0x0D; ``fold`` lower-cases A-Z."""
    t = np.arange(256, dtype=np.uint8)
    if fold:
        t[65:91] += 32
    t[[9, 10, 11, 12, 13, 32]] = 0
    # NUL is a word byte here; 0 is the separator's code, and 0xFF never occurs in UTF-8
    t[0] = 255
    return t


def alnum_table() -> np.ndarray:
    """Words are runs of 0-9, a-z (A-Z folded) and non-ASCII bytes."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    t[:48] = 0
    t[58:65] = 0
    t[91:97] = 0
    t[123:128] = 0
    return t


SPACE_FOLDED, SPACE_EXACT, ALNUM = ascii_space_table(True), ascii_space_table(False), alnum_table()


@dataclass
class Words:
    """The words of a batch of documents."""

    hashes: np.ndarray  # uint64, one per word
    first: np.ndarray  # int64, n_docs + 1: the words of document i are first[i] .. first[i+1]
    begin: np.ndarray  # byte offsets into data
    end: np.ndarray
    data: np.ndarray  # folded bytes

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without copying."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column: pa.Array, table: np.ndarray) -> Words:
    raw, offsets = utf8(column)
    data = table[raw]
    inside = data != 0
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cut = offsets[:-1][offsets[:-1] < len(data)]
    starts[cut] = inside[cut]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    stop = offsets[1:][offsets[1:] > 0] - 1
    ends[stop] = inside[stop]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(data.astype(np.uint64) * _powers(_BASE, len(data)), out=sums[1:])
    hashes = (sums[end] - sums[begin]) * _powers(_INVERSE, len(data) + 1)[begin]
    first = np.searchsorted(begin, offsets)
    return Words(mix(hashes + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), first, begin, end, data)


def windows(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Order-sensitive hash of each run of k words (len - k + 1 of them), across document borders too."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    rng = np.random.default_rng(12345 + 1000 * k + seed)
    out = np.full(n, rng.integers(1, 2**63, dtype=np.uint64))
    for i in range(k):
        out += hashes[i : i + n] * (rng.integers(1, 2**63, dtype=np.uint64) | np.uint64(1))
    return mix(out)


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each document and where each set begins (n_docs + 1).

    A document of fewer than k words, but not none, has its whole sequence as its one shingle.
    """
    counts = np.diff(w.first)
    n_docs = len(counts)
    tokens = windows(w.hashes, k)
    doc = w.doc_of_word()
    inside = doc[: len(tokens)] == doc[k - 1 :] if len(tokens) else np.zeros(0, bool)
    tokens, doc = tokens[inside], doc[: len(inside)][inside]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.concatenate([windows(w.hashes[w.first[i] : w.first[i + 1]], int(counts[i])) for i in short])
        tokens, doc = np.concatenate([tokens, extra]), np.concatenate([doc, short])
    order = np.lexsort((tokens, doc))
    tokens, doc = tokens[order], doc[order]
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (doc[1:] != doc[:-1])
    tokens, doc = tokens[fresh], doc[fresh]
    return tokens, np.searchsorted(doc, np.arange(n_docs + 1))
