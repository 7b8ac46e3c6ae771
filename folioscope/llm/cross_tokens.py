"""Alignment of two tokenizers' cuts of the same text: a transducer over dangling suffixes, and the pairs' counts over the corpus.

The transducer keeps which side leads and the bytes of its last token that the other side has not reached yet. The side behind gives the next token: it
is linked with the leader's token, and what is left over, on either side, is the next state; an empty rest closes a group. Steps are kept by rest and next
token. Both tokenizers end a token before a single space or line break between other characters, so a text is a chain of short stretches that begin and end in the
empty state, and whole stretches are kept too.

1. each document's links as distinct pairs with their multiplicity, in a table (one pass of both tokenizers over whole texts);
2. for each pair the documents that hold it, added up inside tasks before the shuffle; for each id of the first tokenizer its highest count (as many rows as
   the vocabulary has ids);
3. the counts back to the documents: the most frequent pairs, at most ``HEAD`` of them, go to all tasks as arrays; the others, each in few documents, by joins.

Null and empty texts, and those whose joined token bytes differ from space + text, have no tokens: zeros, and '' for the digest. A document is a row: ids may
be null or repeat, and a repeated row counts again. Other columns are not read.
"""

from __future__ import annotations

import gc
import hashlib
import re
from array import array
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, narrow, slices
from .subwords import byte_characters, vocabulary_path

#: Pairs whose counts go to all tasks (two numbers each), pairs that a task adds up before it hands them on, and documents' bytes taken at once.
HEAD, HELD, BYTES = 1 << 20, 1 << 21, 2 << 20


class Transducer:
    """Two token sequences of the same bytes, cut where both end. State 0 is the empty one."""

    LIMIT = 1_000_000

    def __init__(self, first: list[bytes], second: list[bytes]):
        self.sides = (first, second)
        self._empty()

    def _empty(self) -> None:
        self.states: list[tuple[int, bytes]] = [(0, b"")]  # who leads, and its dangling bytes
        self.leads: list[int] = [0]
        self.numbers: dict[tuple[int, bytes], int] = {}
        self.moves: list[dict[int, int]] = [{}]
        self.kept = 0

    def _number(self, side: int, rest: bytes) -> int:
        found = self.numbers.setdefault((side, rest), len(self.states)) if rest else 0
        if found == len(self.states):
            self.states.append((side, rest))
            self.leads.append(side)
            self.moves.append({})
        return found

    def _move(self, state: int, token: int) -> int:
        """The state after the side behind gives ``token``; -1 if its bytes are others. Out of the empty state the first side takes the lead."""
        side, rest = self.states[state]
        if not state:
            after = self._number(0, self.sides[0][token]) or -1
        else:
            got = self.sides[1 - side][token]
            if len(got) <= len(rest):
                after = self._number(side, rest[len(got) :]) if got and rest.startswith(got) else -1
            else:
                after = self._number(1 - side, got[len(rest) :]) if got.startswith(rest) else -1
        self.moves[state][token] = after
        self.kept += 1
        return after

    def run(self, a: list[int], b: list[int]) -> tuple[list[tuple[int, int]], list[int], list[int]] | None:
        """(ends of the groups on both sides, the first and the second ids of the links), or nothing if the sides' bytes differ."""
        if self.kept > self.LIMIT:
            self._empty()
        moves, leads = self.moves, self.leads
        ends, xs, ys = [], [], []
        i = j = y = 0
        try:
            while i < len(a):
                x = a[i]
                i += 1
                state = moves[0].get(x) or self._move(0, x)
                while state > 0:
                    if leads[state]:
                        got = x = a[i]
                        i += 1
                    else:
                        got = y = b[j]
                        j += 1
                    xs.append(x)
                    ys.append(y)
                    after = moves[state].get(got)
                    state = self._move(state, got) if after is None else after
                if state < 0:
                    return None
                ends.append((i, j))
        except IndexError:  # one side ended while its bytes were still asked for
            return None
        return (ends, xs, ys) if j == len(b) else None


def written(a: list[str], b: list[str], ends: list[tuple[int, int]]) -> str:
    """Groups of ids as text."""
    if len(ends) == 1:
        return f"{','.join(a)}|{','.join(b)}"
    out, p, q = [], 0, 0
    for i, j in ends:
        out.append(f"{','.join(a[p:i])}|{','.join(b[q:j])}")
        p, q = i, j
    return ";".join(out)


# The split of the byte-level vocabulary (fixed value): contractions, and letters, digits and signs with a space before them.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_level(path: str):
    """(encode, bytes of each id) of a byte-level vocabulary file whose ids are the ranks of its merges, as ordinary text without special tokens."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(model["vocab"][x + y] != 256 + k for k, (x, y) in enumerate(pairs)):
        raise ValueError("ids that are no ranks")
    stands_for = {c: b for b, c in byte_characters().items()}
    ranks = {bytes(map(stands_for.__getitem__, t)): i for t, i in model["vocab"].items() if i < 256 + len(pairs)}
    parts = [b""] * (max(ranks.values()) + 1)
    for t, i in ranks.items():
        parts[i] = t
    return tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, parts


class Aligner(dict):
    """Both tokenizers in a worker process: (tokens, groups as text, links as pair codes) of each stretch, kept by its text.

    ``tokens`` holds both counts, the first side's in the upper half. Stretches of up to ``SHORT`` characters are kept in two generations of ``LIMIT``.
    """

    LIMIT, SHORT = 200_000, 48
    _shared: dict[tuple[str, str], Aligner] = {}
    _SOLID = "[^\\s᠎]"
    _CUT = re.compile(f"(?<={_SOLID})(?=[ \n]{_SOLID})")
    _AWKWARD = re.compile("[\\s᠎][\\s᠎]|\\A[\\s᠎]|[\\s᠎]\\Z")

    def __init__(self, first: str, second: str):
        super().__init__()
        import sentencepiece

        self.old: dict = {}
        self.encode_a, a_bytes = byte_level(vocabulary_path(first))
        pieces = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(second))
        self.encode_b = pieces.encode
        names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.width = len(b_bytes)
        self.codes = np.dtype("<u4") if len(a_bytes) * len(b_bytes) < 1 << 32 else np.dtype("<i8")
        self.steps = Transducer(a_bytes, b_bytes)
        self.names = list(map(str, range(max(len(a_bytes), len(b_bytes)))))
        self.space = pieces.piece_to_id("▁")

    @classmethod
    def shared(cls, first: str, second: str) -> Aligner:
        """One for each worker process."""
        if (first, second) not in cls._shared:
            cls._shared[first, second] = cls(first, second)
        return cls._shared[first, second]

    def _aligned(self, text: str, a: list[int], b: list[int]):
        """None unless both sides' bytes are the text's."""
        found = self.steps.run(a, b)
        if found is None or b"".join(map(self.steps.sides[0].__getitem__, a)) != text.encode():
            return None
        ends, xs, ys = found
        name, width = self.names.__getitem__, self.width
        kind = "I" if self.codes.itemsize == 4 else "q"
        return (len(a) << 32 | len(b)), written(list(map(name, a)), list(map(name, b)), ends), array(kind, [x * width + y for x, y in zip(xs, ys, strict=True)]).tobytes()

    def __missing__(self, stretch: str):
        """A stretch begins with a space, which the second tokenizer adds itself, or with a line break, before which its space is taken off."""
        got = self.old.get(stretch)
        if got is None:
            if stretch[0] == " ":
                got = self._aligned(stretch, self.encode_a(stretch), self.encode_b(stretch[1:]))
            else:
                b = self.encode_b(stretch)
                got = self._aligned(stretch, self.encode_a(stretch), b[1:]) if b[:1] == [self.space] else None
        if len(stretch) <= self.SHORT:
            if len(self) >= self.LIMIT:
                self.old = dict(self)
                self.clear()
            self[stretch] = got
        return got

    def document(self, text: str):
        """(tokens, groups, codes) of a whole text, or None."""
        if not text:
            return None
        if self._AWKWARD.search(text):
            parts = self._CUT.split(text)
            found = [self[" " + parts[0]], *map(self.__getitem__, parts[1:])]
        else:
            found = [self[p if p[0] == "\n" else " " + p] for p in text.replace("\n", " \n").split(" ")]
        if None in found:  # a stretch of other bytes: nearly always the text's are others too
            return self._aligned(" " + text, self.encode_a(" " + text), self.encode_b(text))
        return sum(map(itemgetter(0), found)), ";".join(map(itemgetter(1), found)), b"".join(map(itemgetter(2), found))


def _counts_type(counts: np.ndarray) -> np.dtype:
    return next(np.dtype(t) for t in ("<u1", "<u2", "<u4") if not len(counts) or counts.max() <= np.iinfo(t).max)


_LINKED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, many binary"


def _links(first: str, second: str):
    """Each document's counts, digest, and distinct pairs (sorted, as differences) with their multiplicities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Aligner.shared(first, second)

        def linked(text: str) -> tuple:
            if (got := both.document(text)) is None:
                return 0, 0, 0, 0, "", b"", b""
            tokens, groups, links = got
            links = np.frombuffer(links, both.codes)
            codes, many = np.unique(links, return_counts=True)
            sha = hashlib.sha256(groups.encode()).hexdigest()
            return tokens >> 32, tokens & 0xFFFFFFFF, groups.count(";") + 1, len(links), sha, np.diff(codes, prepend=codes.dtype.type(0)).tobytes(), many.astype(_counts_type(many)).tobytes()

        for b in slices(batches, BYTES):
            gc.disable()  # very many small objects and no cycles among them
            try:
                rows = [linked(text) for text in b.column(1).to_pylist()]
            finally:
                gc.enable()
            columns = zip(*rows, strict=True)
            kinds = (pa.int64(),) * 4 + (pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(2), b.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]], names=[x.split()[0] for x in _LINKED.split(", ")])

    return run


def _decoded(codes: bytes, many: bytes, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    codes = np.cumsum(np.frombuffer(codes, kind), dtype=kind).astype(np.int64)
    return codes, np.frombuffer(many, f"<u{len(many) // len(codes)}" if len(codes) else "<u1").astype(np.int64)


def _added_up(kind: np.dtype):
    """(code, docs): documents that hold each pair, added up in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, docs = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list[np.ndarray] = []
        n = 0

        def merge():
            fresh = np.concatenate([codes, *waiting])
            weight = np.concatenate([docs, np.ones(len(fresh) - len(docs), np.int64)])
            distinct, at = np.unique(fresh, return_inverse=True)
            return distinct, np.bincount(at, weights=weight, minlength=len(distinct)).astype(np.int64)

        out = lambda: pa.RecordBatch.from_arrays([pa.array(codes), pa.array(docs)], names=["code", "docs"])
        for b in batches:
            for x in b.column(0):
                waiting.append(np.cumsum(np.frombuffer(x.as_buffer(), kind), dtype=kind).astype(np.int64))
                n += len(waiting[-1])
                if n >= HELD:
                    codes, docs = merge()
                    waiting, n = [], 0
                    if len(codes) >= HELD:
                        yield out()
                        codes, docs = codes[:0], docs[:0]
        codes, docs = merge()
        if len(codes):
            yield out()

    return run


def _scored(shared, kind: np.dtype, width: int):
    """Sums over a document's frequent pairs; its other pairs are handed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, docs, best = shared.value
        for b in batches:
            n_best, total, codes_left, many_left = [], [], [], []
            for raw, times in zip(b.column("codes"), b.column("many"), strict=True):
                codes, many = _decoded(raw.as_buffer(), times.as_buffer(), kind)
                at = np.minimum(np.searchsorted(head, codes), max(len(head) - 1, 0))
                known = head[at] == codes if len(head) else np.zeros(len(codes), bool)
                count = docs[at[known]]
                total.append(int((count * many[known]).sum()))
                n_best.append(int(many[known][count == best[codes[known] // width]].sum()))
                codes_left.append(codes[~known])
                many_left.append(many[~known])
            lists = [pa.array([x.tolist() for x in xs], pa.list_(pa.int64())) for xs in (codes_left, many_left)]
            names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), *lists], names=[*names, "n_best", "count_sum", "codes", "many"])

    return run


def cross_alignment(docs: DataFrame, first: str, second: str, head: int | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each document.

    ``first`` is a byte-level vocabulary, given space + text; ``second`` a piece model with byte fallback that adds the space itself.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "cross-tokens")
    both = Aligner.shared(first, second)
    kind, width, n_first = both.codes, both.width, len(both.steps.sides[0])
    rows = narrow(docs, "doc_id", "text").select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    linked = scratch.save(rows.mapInArrow(_links(first, second), _LINKED), "linked")
    parts = linked.select("codes").where(F.length("codes") > 0).mapInArrow(_added_up(kind), "code long, docs long")
    counts = scratch.save(parts.groupBy("code").agg(F.sum("docs").alias("docs")), "counts")
    best = np.zeros(n_first, np.int64)
    for r in counts.groupBy(F.floor(F.col("code") / width).alias("a")).agg(F.max("docs").alias("docs")).collect():
        best[r.a] = r.docs
    # the frequent pairs: the lowest power of two above which no more than HEAD pairs count
    sizes = {int(r.size): r.n for r in counts.groupBy(F.floor(F.log2("docs")).alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, n = 1 << 62, 0
    for size in sorted(sizes, reverse=True):
        n += sizes[size]
        if n > (HEAD if head is None else head):
            break
        least = 1 << size
    frequent = counts.where(F.col("docs") >= least).toArrow() if least < 1 << 62 else None
    codes, docs_of = (frequent.column(i).to_numpy() for i in (0, 1)) if frequent is not None else (np.zeros(0, np.int64),) * 2
    order = np.argsort(codes)
    shared = spark.sparkContext.broadcast((codes[order], docs_of[order], best))
    shape = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, codes array<long>, many array<long>"
    scored = linked.mapInArrow(_scored(shared, kind, width), shape)
    if len(codes) < sum(sizes.values()):
        scored = scratch.save(scored, "scored")
        rare = scored.select("row", F.explode(F.arrays_zip("codes", "many")).alias("x")).select("row", F.col("x.codes").alias("code"), F.col("x.many").alias("many"))
        a = F.floor(F.col("code") / width)
        few = rare.join(counts.where(F.col("docs") < least), "code").withColumn("best", F.lit(None).cast("long"))
        tops = spark.createDataFrame(pa.table({"a": np.flatnonzero(best), "top": best[best > 0]}))
        few = few.drop("best").withColumn("a", a).join(F.broadcast(tops), "a")
        sums = few.groupBy("row").agg(F.sum(F.col("docs") * F.col("many")).alias("more"), F.sum(F.when(F.col("docs") == F.col("top"), F.col("many")).otherwise(0)).alias("bests"))
        scored = scored.drop("codes", "many").join(sums, "row", "left")
        scored = scored.withColumn("n_best", F.col("n_best") + F.coalesce("bests", F.lit(0))).withColumn("count_sum", F.col("count_sum") + F.coalesce("more", F.lit(0)))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
