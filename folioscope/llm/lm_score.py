"""Operator 3, LM scoring with a causal self-attention model trained in numpy on subword ids.

1. Every training document's words are counted: per task first, then by bucket of the word's hash. The word counts (the lexicon) stay
   distributed; of them only the ``HEAD_WORDS`` most frequent reach the driver.
2. The ``WHOLE_WORDS`` most frequent words, which occur ``WHOLE_LEAST`` times at least, get an id of their own; the others are spelled in
   subword ids. So a text takes fewer ids, all of which are trained on and scored. Of their counts, one for each id reaches the driver.
3. The attention model is fitted on the ids of all training documents, in ``ROUNDS`` rounds. A hash deals the documents to the cells of a round; a task
   streams a cell's documents in chunks and trains from the round's common parameters, and the cells' mean, weighted by tokens, starts the next round.
   Cells and their sizes grow with the corpus; every token is a target at least once, and a cell takes its share of ``FIT_STEPS`` steps at least. The
   output layer is completed with the id counts of the whole corpus.
4. Each document is scored whole, in overlapping windows (see ``attention``). A word's probability is ``ATTENTION_SHARE`` of what the attention model
   gives its ids, and for the rest its share of the lexicon's tokens. Words outside the head go by bucket to the lexicon's rows, packed, and come
   back as sums. A bucket is sorted by Spark and streamed; only its part of the lexicon is held.

A training document is one whose crc32(doc_id as text) mod 7 is not 2. Words are lower-cased (A-Z) runs of non-space; the end of a text is a token.

Defined cases: null, empty and blank texts are the end token alone; with nothing to learn from, N and V are 0; repeated rows count and are
scored each by itself; other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .attention import Model, Vocabulary
from .langid import held_out
from .scratch import Scratch, narrow, partitions, slices
from .subwords import vocabulary_path
from .wordhash import SPACE_FOLDED, Words, words

#: Words with an id of their own, as many as ids of two bytes and one more symbol leave beside the 32,000 pieces, and the occurrences that one needs.
WHOLE_WORDS, WHOLE_LEAST = 33_500, 100
HEAD_WORDS, ROUNDS, FIT_STEPS, RATE, ATTENTION_SHARE = 200_000, 8, 400, 0.02, 0.9
#: Tokens of a cell: so many times the root of the corpus, and so many at least; with fewer tokens than that, every round reads all documents.
CELL_GROWTH, CELL_TOKENS = 50, 1_000_000
#: Tokens that a cell's task holds at once.
CHUNK_TOKENS = 1 << 18
FLUSH_WORDS, SLICE = 1_000_000, 2 << 20
#: The hash that stands for the end of a text; no word is likelier to have it than any other.
END_HASH = np.uint64(0x51AFD7ED558CCD25)
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes in order, where each of them occurs, and which of them each is."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    fresh = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=fresh[1:])
    nth = np.empty(len(ordered), np.int64)
    nth[order] = np.cumsum(fresh) - 1
    return ordered[fresh], order[fresh], nth


def _found(known: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the hashes in sorted known ones, and which of them are there."""
    if not len(known):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return place, known[place] == hashes


def _appended(array: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
    """The array, of which n entries are in use, with more behind them; it doubles when full."""
    if n + len(more) > len(array):
        array = np.concatenate([array[:n], np.empty(n + 2 * len(more), array.dtype)])
    array[n : n + len(more)] = more
    return array


class Pieces:
    """The ids of words, kept by the words' hashes; of about ``LIMIT`` words at most. Words among ``whole`` have one id."""

    LIMIT, LATE = 4_000_000, 50_000
    _shared: dict[str, Pieces] = {}

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size, self.end = self.model.get_piece_size(), self.model.eos_id()
        self.whole = np.zeros(0, np.uint64)
        self.forget()

    def forget(self) -> None:
        #: Hashes in order and their rows, of most words and of those learnt since.
        self.known, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.late, self.late_row = self.known, self.row
        #: Ids of all rows, laid end to end, and where those of each row end; the end id is row 0.
        self.pool, self.ends, self.n = np.array([self.end], np.uint16), np.array([0, 1], np.int32), 1

    @classmethod
    def shared(cls, name: str, whole: np.ndarray | None = None) -> Pieces:
        if name not in cls._shared:
            cls._shared[name] = cls(name if os.sep in name else vocabulary_path(name))
        own = cls._shared[name]
        if whole is not None and not np.array_equal(own.whole, whole):
            own.whole = whole
            own.forget()
        return own

    def _learn(self, hashes: np.ndarray, words_: list[bytes]) -> None:
        """Keep the ids of new words, whose hashes are in order. One that normalises to nothing is the unknown piece, so that every word has an id; a single piece stays as it is."""
        found = self.model.encode(b" ".join(words_).decode("utf-8", "replace").split(" "), num_threads=1)
        length = np.fromiter(map(len, found), np.int64, len(found))
        for k in np.flatnonzero(length == 0):
            found[k], length[k] = [0], 1
        ids = np.fromiter(chain.from_iterable(found), np.uint16, int(length.sum()))
        nth, own = _found(self.whole, hashes)
        own &= length > 1
        first = np.cumsum(length) - length
        kept = np.repeat(~own, length)
        kept[first[own]] = True
        ids[first[own]] = self.size + nth[own]
        ids, length[own] = ids[kept], 1
        used = int(self.ends[self.n])
        self.pool = _appended(self.pool, used, ids)
        self.ends = _appended(self.ends, self.n + 1, used + np.cumsum(length))
        rows = np.arange(self.n, self.n + len(hashes), dtype=np.int32)
        self.n += len(hashes)
        place = np.searchsorted(self.late, hashes)
        self.late, self.late_row = np.insert(self.late, place, hashes), np.insert(self.late_row, place, rows)
        if len(self.late) > max(self.LATE, len(self.known) // 8):
            place = np.searchsorted(self.known, self.late)
            self.known, self.row = np.insert(self.known, place, self.late), np.insert(self.row, place, self.late_row)
            self.late, self.late_row = self.late[:0], self.late_row[:0]

    def _rows(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each word, 0 for those not known."""
        rows = np.zeros(len(hashes), np.int32)
        for known, row in ((self.known, self.row), (self.late, self.late_row)):
            place, there = _found(known, hashes)
            rows[there] = row[place[there]]
        return rows

    def stream(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the batch's documents laid end to end, each closed by the end id; how many each token has; the tokens of each document;
        the hashes of distinct tokens, and which of them each token is."""
        distinct, first, nth = _distinct(w.hashes)
        rows = self._rows(distinct)
        new = rows == 0
        if new.any():
            if self.n + int(new.sum()) > self.LIMIT:
                self.forget()
                new[:] = True
            data = w.data.tobytes().replace(b"\xff", b"\0")  # how NUL is folded
            which = first[new]
            self._learn(distinct[new], [data[b:e] for b, e in zip(w.begin[which].tolist(), w.end[which].tolist(), strict=True)])
            rows = self._rows(distinct)
        rows = np.append(rows, 0)  # the end token comes last
        at, length = (x.astype(np.int64) for x in (self.ends[rows], self.ends[rows + 1] - self.ends[rows]))
        kind = np.insert(nth, w.first[1:], len(distinct))
        size = length[kind]
        place = np.repeat(at[kind] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        return self.pool[place].astype(np.int64), size, np.diff(w.first) + 1, np.append(distinct, END_HASH), kind


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join(a.tobytes() for a in arrays)


def _bucketed(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, rows of it)."""
    bucket = (hashes >> np.uint64(40)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    ordered = bucket[order]
    edges = np.flatnonzero(np.diff(ordered, prepend=np.uint64(buckets), append=np.uint64(buckets)))
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        yield int(ordered[s]), order[s:e]


def _sum_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, at = np.unique(keys, return_inverse=True)
    return unique, np.bincount(at, values, len(unique)).astype(np.int64)


def _count(buckets: int):
    """Counts of a task: words by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n_held = n_docs = 0

        def flush() -> pa.RecordBatch:
            h, c = _sum_by(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
            rows = [(b, _pack(h[at], c[at])) for b, at in _bucketed(h, buckets)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=["bucket", "payload"])

        for b in slices(batches):
            n_docs += b.num_rows
            held.append(np.unique(words(b.column(1), SPACE_FOLDED).hashes, return_counts=True))
            n_held += len(held[-1][0])
            if n_held >= FLUSH_WORDS:
                yield flush()
                n_held = 0
        held.append((np.array([END_HASH]), np.array([n_docs])))
        yield flush()

    return run


_GATHERED = "id int, c long, key long, ids binary"


def _gather(vocabulary: str, whole):
    """The ids of each document under its key, and a task's counts of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.shared(vocabulary, whole.value)
        ids = np.zeros(pieces.size + len(pieces.whole), np.int64)
        names = [x.split()[0] for x in _GATHERED.split(", ")]
        for b in slices(batches):
            stream, size, n_words = pieces.stream(words(b.column(1), SPACE_FOLDED))[:3]
            ids += np.bincount(stream, minlength=len(ids))
            ends = np.cumsum(np.add.reduceat(size, np.cumsum(n_words) - n_words)) * 2
            raw = stream.astype(np.uint16).tobytes()
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), b.column(2), pa.array([raw[s:e] for s, e in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)], pa.binary())], names=names)
        used = np.flatnonzero(ids)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(ids[used]), pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.binary())], names=names)

    return run


def _counts(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) // 16
    return np.frombuffer(blob, np.uint64, n), np.frombuffer(blob, np.int64, n, 8 * n)


def _magnitude(counts: np.ndarray) -> np.ndarray:
    return np.minimum((np.log2(counts) * 8).astype(np.int64), 511)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One lexicon row for each bucket: sorted hashes and counts, their numbers, and how many words are of each magnitude. The rows come sorted by bucket."""
    for bucket, rows in groupby(((x, y) for b in batches for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)), itemgetter(0)):
        h, c = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held, n_held = [], 0
        for blob in chain((x for _, x in rows), [None]):
            if blob is not None:
                held.append(_counts(blob))
                n_held += len(held[-1][0])
            if blob is None or n_held > max(FLUSH_WORDS, len(h)):  # so that no more than twice the bucket's words are held
                h, c = _sum_by(np.concatenate([h, *(p[0] for p in held)]), np.concatenate([c, *(p[1] for p in held)]))
                held, n_held = [], 0
        h, c = h[c > 0], c[c > 0]
        size = np.bincount(_magnitude(c), minlength=512) if len(c) else np.zeros(512, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([_pack(h, c)], pa.binary()), pa.array([len(h)], pa.int64()), pa.array([int(c.sum())], pa.int64()), pa.array([size.tolist()], pa.list_(pa.int64()))], names=["bucket", "payload", "n_words", "n_tokens", "sizes"])


def _head(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blob in b.column(1).to_pylist():
                h, c = _counts(blob)
                big = _magnitude(c) >= least if len(c) else np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays([pa.array(h[big].view(np.int64)), pa.array(c[big])], names=["hash", "c"])

    return run


def _whole(head: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The hashes, sorted, of the words that get an id of their own."""
    fit_ = np.flatnonzero((counts >= WHOLE_LEAST) & (head != END_HASH))
    return np.sort(head[fit_[np.argsort(-counts[fit_], kind="stable")[:most]]])


def _mixed(lp: np.ndarray, c: np.ndarray, total: int) -> np.ndarray:
    """ln of the mean of the attention model's probability and the lexicon's share."""
    share = (1 - ATTENTION_SHARE) * c / max(total, 1)
    with np.errstate(divide="ignore"):
        return np.where(share > 0, np.log(ATTENTION_SHARE * np.exp(lp) + share), lp + np.log(ATTENTION_SHARE))


_SCORED = "uid long, doc_id long, n_tokens long, n_known long, base double, score double, bucket int, payload binary"


def _score(vocabulary: str, shared, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, head, counts, total, whole = shared.value
        pieces, tables = Pieces.shared(vocabulary, whole), model.tables()
        uid = TaskContext.get().partitionId() << 40
        for b in slices(batches, SLICE):
            n_docs = b.num_rows
            ids, size, n_words, distinct, kind = pieces.stream(words(b.column(1), SPACE_FOLDED))
            first = np.cumsum(n_words) - n_words
            lengths = np.add.reduceat(size, first)
            lp = np.add.reduceat(model.score(ids, lengths, tables).astype(np.float64), np.cumsum(size) - size)
            doc = np.repeat(np.arange(n_docs), n_words)
            at, there = _found(head, distinct)
            c = np.zeros(len(distinct), np.int64)
            c[there] = counts[at[there]]
            inside = there[kind]
            of, own = doc[inside], kind[inside]
            base = np.bincount(of, np.log10(c + 1)[own], n_docs)
            score = np.bincount(of, _mixed(lp[inside], c[own], total), n_docs)
            known = np.bincount(of, (c > 0)[own], n_docs).astype(np.int64)
            uids = uid + np.arange(n_docs)
            uid += n_docs
            none = lambda kind, n: pa.nulls(n, kind)
            yield pa.RecordBatch.from_arrays([pa.array(uids), b.column(0), pa.array(n_words), pa.array(known), pa.array(base), pa.array(score), none(pa.int32(), n_docs), none(pa.binary(), n_docs)], names=[x.split()[0] for x in _SCORED.split(", ")])
            far = np.flatnonzero(~inside)
            hashes = distinct[kind[far]]
            rows = [(k, _pack(hashes[r], uids[doc[far[r]]], lp[far[r]].astype(np.float32))) for k, r in _bucketed(hashes, buckets)]
            n = len(rows)
            yield pa.RecordBatch.from_arrays([*(none(k, n) for k in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())), pa.array([k for k, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=[x.split()[0] for x in _SCORED.split(", ")])

    return run


def _tail(total: int):
    """Sums for words outside the head: the lexicon's row of a bucket meets the words of the documents. The rows come sorted by bucket and kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, h, c = None, *_counts(b"")
        for b in batches:
            for (kind, bucket), rows in groupby(zip(*(x.to_pylist() for x in b.columns[:3]), strict=True), itemgetter(0, 1)):
                blobs = [x for _, _, x in rows]
                if bucket != own:
                    own, h, c = bucket, *_counts(b"")
                if kind == 0:  # the lexicon's row is the first of a bucket
                    h, c = _counts(blobs[0])
                    continue
                words_, uids, lp = (np.concatenate([np.frombuffer(x, k, len(x) // 20, at * (len(x) // 20)) for x in blobs]) for k, at in ((np.uint64, 0), (np.int64, 8), (np.float32, 16)))
                if len(h):
                    at = np.minimum(np.searchsorted(h, words_), len(h) - 1)
                    count = np.where(h[at] == words_, c[at], 0)
                else:
                    count = np.zeros(len(words_), np.int64)
                first = np.flatnonzero(np.concatenate([[True], np.diff(uids) != 0]))  # a document's words lie together
                sums = [np.add.reduceat(x, first) for x in (np.log10(count + 1), _mixed(lp.astype(np.float64), count, total), (count > 0).astype(np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array(uids[first]), *map(pa.array, sums)], names=["uid", "base", "score", "known"])

    return run


def _train(shared, nth: int):
    """The parameters that a round's common ones become in each cell of it, and the tokens they saw. The rows come sorted by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cell, seen, state, held, n_held = None, None, 0, {}, [], 0
        rate, least = RATE * (1 - 0.9 * nth / ROUNDS), -(-FIT_STEPS // ROUNDS)

        def learn(least: int) -> None:
            nonlocal held, n_held
            ids = np.concatenate(held).astype(np.int64)
            model.train(ids, np.array([len(x) for x in held]), least, rate, state, seed=cell + state.get("t", 0))
            held, n_held = [], 0

        def finished() -> pa.RecordBatch:
            learn(least)
            return pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.array([seen], pa.int64()), pa.array([model.packed().tobytes()], pa.binary())], names=["cell", "n", "payload"])

        for b in batches:
            for of, blob in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if of != cell:
                    if held:
                        yield finished()
                    model, cell, seen, state = shared.value.copy(), of, 0, {}
                elif n_held >= CHUNK_TOKENS:
                    learn(0)
                held.append(np.frombuffer(blob, np.uint16))
                n_held += len(held[-1])
                seen += len(held[-1])
        if held:
            yield finished()

    return run


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a partition: the tokens of all its parameters, and their mean weighted by tokens."""
    total, seen = 0.0, 0
    for b in batches:
        for n, blob in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            total = total + np.frombuffer(blob, np.float32) * np.float64(n)
            seen += n
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([seen], pa.int64()), pa.array([(total / seen).astype(np.float32).tobytes()], pa.binary())], names=["cell", "n", "payload"])


def fit(sequences: DataFrame, id_counts: np.ndarray, scratch: Scratch) -> Model:
    """The attention model, from the (round, key, ids) of all training documents, which lie by round."""
    spark = sequences.sparkSession
    model = Model(Vocabulary(id_counts))
    n = int(id_counts.sum())
    if not n:
        return model
    cells = -(-n // int(ROUNDS * max(CELL_TOKENS, CELL_GROWTH * n**0.5)))
    small = n < CELL_TOKENS  # all documents in every round
    # ROUNDS divides the number, so a cell's documents are all of one round
    dealt = sequences.withColumn("cell", F.pmod("key", F.lit(cells * (1 if small else ROUNDS))).cast("int"))
    kind = "cell int, n long, payload binary"
    for nth in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)
        mine = (dealt if small else dealt.where(F.col("round") == nth)).select("cell", "key", "ids")
        mine = mine.repartition(max(cells, partitions(spark)), "cell").sortWithinPartitions("cell", "key")
        trained = scratch.save(mine.mapInArrow(_train(shared, nth), kind), f"round{nth}")
        # two steps of sums, so that the driver gets the root of the cells at most
        sums = trained.repartition(max(1, round(cells**0.5)), "cell").sortWithinPartitions("cell").mapInArrow(_total, kind)
        (mean,) = list(_total(sums.toArrow().to_batches())) or [None]
        if mean is not None:
            model = model.copy()
            model.unpack(np.frombuffer(mean.column(2)[0].as_py(), np.float32))
        shared.unpersist()
        scratch.drop(f"round{nth}")
    return model


def lm_scores(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per document: the base and the model's log10 probability, and the counts they rest on."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm-score")
    width = partitions(spark)
    buckets = 4 * width
    texts = narrow(docs, "doc_id", "text")
    train = texts.where(~held_out("doc_id", 7, 2)).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))

    counted = train.mapInArrow(_count(buckets), "bucket int, payload binary").repartition(width, "bucket").sortWithinPartitions("bucket")
    lexicon = scratch.save(counted.mapInArrow(_merge, "bucket int, payload binary, n_words long, n_tokens long, sizes array<long>"), "lexicon")
    n_words, total = (x or 0 for x in lexicon.agg(F.sum("n_words"), F.sum("n_tokens")).first())
    sizes = {r.at: r.n for r in lexicon.select(F.inline(F.filter(F.transform("sizes", lambda n, at: F.struct(at.alias("at"), n.alias("n"))), lambda x: x["n"] > 0))).groupBy("at").agg(F.sum("n").alias("n")).collect()}
    least, n = 512, 0
    while least and n + sizes.get(least - 1, 0) <= HEAD_WORDS:
        least -= 1
        n += sizes.get(least, 0)
    rows = lexicon.mapInArrow(_head(least), "hash long, c long").toArrow() if n else None
    head = rows.column(0).to_numpy().view(np.uint64) if n else np.zeros(0, np.uint64)
    counts = rows.column(1).to_numpy() if n else np.zeros(0, np.int64)
    order = np.argsort(head)
    head, counts = head[order], counts[order]
    whole = spark.sparkContext.broadcast(_whole(head, counts, min(WHOLE_WORDS, 65_535 - Pieces.shared(vocabulary).size)))
    gathered = train.mapInArrow(_gather(vocabulary, whole), _GATHERED).withColumn("round", F.coalesce(F.pmod("key", F.lit(ROUNDS)), F.lit(-1)).cast("int"))
    gathered = scratch.save(gathered, "gathered", "round")  # so that a round reads its own documents alone
    id_counts = np.zeros(Pieces.shared(vocabulary).size + len(whole.value))
    for r in gathered.where("round < 0").groupBy("id").agg(F.sum("c").alias("c")).collect():  # at most one row for each id
        id_counts[r.id] = r.c
    model = fit(gathered.where("round >= 0").select("round", "key", "ids"), id_counts, scratch)
    scratch.drop("gathered")
    shared = spark.sparkContext.broadcast((model, head, counts, total, whole.value))

    scored = scratch.save(texts.mapInArrow(_score(vocabulary, shared, buckets), _SCORED), "scored")
    asked = scored.where("bucket is not null").select(F.lit(1).alias("kind"), "bucket", "payload")
    both = lexicon.select(F.lit(0).alias("kind"), "bucket", "payload").unionByName(asked).repartition(width, "bucket").sortWithinPartitions("bucket", "kind")
    tail = both.mapInArrow(_tail(total), "uid long, base double, score double, known long")
    tail = tail.groupBy("uid").agg(F.sum("base").alias("tail_base"), F.sum("score").alias("tail_score"), F.sum("known").alias("tail_known"))
    out = scored.where("uid is not null").join(tail, "uid", "left").na.fill(0, ["tail_base", "tail_score", "tail_known"])
    share = float(np.log10(total + n_words + 1))
    return out.select(
        "doc_id", held_out("doc_id", 7, 2).alias("held_out"), "n_tokens", (F.col("n_known") + F.col("tail_known")).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("tail_base") - F.col("n_tokens") * share).alias("base_score"), ((F.col("score") + F.col("tail_score")) / float(np.log(10))).alias("score"),
    )
