"""A small causal self-attention language model in numpy: its training and its batched, masked scoring.

One attention layer over learned embeddings of all ids with a bias for each distance, a ReLU layer and a softmax in two steps: a band
of frequency, then a class of the band. The most frequent ids are classes of their own; the others share the last band's classes, within
which the corpus counts decide.

Training cuts a text's ids into runs of ``WINDOW``, each position of which is a target once. Scoring uses windows that overlap: each scores
its last ``STRIDE`` positions and sees ``WINDOW - STRIDE`` earlier ones at least, so every token is scored once. Positions before the text
hold the begin symbol.
"""

from __future__ import annotations

from copy import copy

import numpy as np

WINDOW, STRIDE, DIM, HIDDEN, BANDS, MEMBERS = 16, 12, 16, 16, 32, 32
CLASSES = BANDS * MEMBERS
#: Ids that are classes of their own, and classes that the others share.
SINGLES, BINS = CLASSES - MEMBERS, MEMBERS
#: Windows of a training step and of a scoring chunk, small enough for a core's cache.
STEP, CHUNK = 512, 512
_FAR, _MOST = np.float32(-1e9), np.float32(60)
_LARGEST = np.exp(_MOST)


class Vocabulary:
    """Output classes of ids, from their counts in the corpus."""

    def __init__(self, counts: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(counts), np.int64)
        rank[order] = np.arange(len(counts))
        spread = np.minimum(np.log2(np.maximum(rank - SINGLES, 0) + 1) * 2, BINS - 1).astype(np.int64)
        group = np.where(rank < SINGLES, rank, SINGLES + spread)
        smooth = counts + 0.5
        prior = np.bincount(group, smooth, CLASSES)
        self.size = len(counts)
        self.band, self.member = (group // MEMBERS).astype(np.uint8), (group % MEMBERS).astype(np.uint8)
        self.inside = np.log(smooth / prior[group]).astype(np.float32)
        band = np.maximum(prior, 1e-9).reshape(BANDS, MEMBERS)
        self.band_prior = np.log(band.sum(1) / band.sum()).astype(np.float32)
        self.prior = np.log(band / band.sum(1, keepdims=True)).astype(np.float32)


def windows(ids: np.ndarray, lengths: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of documents laid end to end: the symbols of all windows, the places of their last ``stride`` positions, and which of those are in the text.

    The symbol at a position is the id before it plus one, or 0 at and before a text's begin.
    """
    n = -(-lengths // stride)
    ends = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(lengths)), n)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    begin, end = (ends - lengths)[doc], ends[doc]
    place = (begin + nth * stride)[:, None] + np.arange(stride - WINDOW, stride)
    symbols = np.zeros(len(ids) + 1, np.uint32)
    symbols[1:] = ids
    symbols[1:] += 1
    x = symbols[np.clip(place, 0, len(ids))]
    x[place <= begin[:, None]] = 0
    scored = place[:, -stride:]
    return x, np.minimum(scored, max(0, len(ids) - 1)), scored < end[:, None]


def by_band(band: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order of the rows by band, and each band's rows in it."""
    order = np.argsort(band, kind="stable")
    edge = np.concatenate([[0], np.cumsum(np.bincount(band, minlength=BANDS))]).tolist()
    return order, [(b, slice(edge[b], edge[b + 1])) for b in range(BANDS) if edge[b] < edge[b + 1]]


def _exp(make, members: int) -> tuple[np.ndarray, np.ndarray]:
    """The exponentials of what ``make`` returns, in its place, and the sums of each ``members`` of them. They are kept finite: larger entries, which hardly occur, are cut to the same bound."""
    ones = np.ones(members, np.float32)
    for cut in (False, True):
        x = make()
        if cut:
            np.minimum(x, _MOST, out=x)
        with np.errstate(over="ignore"):
            np.exp(x, out=x)
            total = x.reshape(-1, members) @ ones
        if cut or not total.size or total.max() <= _LARGEST:
            return x, total


class Model:
    def __init__(self, vocabulary: Vocabulary, seed: int = 7):
        rng = np.random.default_rng(seed)
        make = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.vocabulary = vocabulary
        self.p = {
            "E": (rng.standard_normal((vocabulary.size + 1, DIM)) * 0.3).astype(np.float32), "Wq": make(DIM, DIM) / np.float32(np.sqrt(DIM)), "Wkv": make(DIM, 2 * DIM),
            "W1": make(DIM, HIDDEN), "W2": make(HIDDEN, DIM) * np.float32(0.5), "far": (-0.1 * np.arange(WINDOW)).astype(np.float32),
            # both output layers end in a row of biases
            "U1": np.concatenate([make(DIM, BANDS), vocabulary.band_prior[None]]), "U2": np.concatenate([make(BANDS, DIM, MEMBERS) * np.float32(np.sqrt(BANDS / DIM)), vocabulary.prior[:, None]], axis=1),
        }

    def _bias(self, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What distance adds to the attention of the last ``stride`` positions, the distances, and which positions lie ahead."""
        distance = np.arange(WINDOW - stride, WINDOW)[:, None] - np.arange(WINDOW)
        ahead, distance = distance < 0, np.maximum(distance, 0)
        return np.where(ahead, _FAR, self.p["far"][distance]).astype(np.float32), distance, ahead

    def _attended(self, q: np.ndarray, k: np.ndarray, v: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each position takes from those it sees, and its weights. Shapes: (windows, stride, DIM), twice (windows, WINDOW, DIM)."""

        def logits() -> np.ndarray:
            a = q @ k.transpose(0, 2, 1)
            a += bias
            return a

        a, total = _exp(logits, WINDOW)
        a /= total.reshape(*a.shape[:2], 1)
        return (a @ v).reshape(-1, DIM), a

    def _outputs(self) -> np.ndarray:
        """Both output layers of each band side by side, so that a band's rows meet them in one product: (BANDS, DIM + 1, BANDS + MEMBERS)."""
        return np.concatenate([np.broadcast_to(self.p["U1"], (BANDS, DIM + 1, BANDS)), self.p["U2"]], axis=2)

    def _exponentials(self, h: np.ndarray, parts: list[tuple[int, slice]], outputs: np.ndarray, at: np.ndarray | None):
        """Of rows in order of their bands: their hidden layer, the last layer's input with a column of ones for the biases, the exponentials of both softmaxes, their sums, and the logits at ``at``, if asked for."""
        z = h @ self.p["W1"]
        np.maximum(z, 0, out=z)
        g, inner = np.ones((len(h), DIM + 1), np.float32), z @ self.p["W2"]
        inner += h
        g[:, :DIM] = inner
        picked = None

        def logits() -> np.ndarray:
            nonlocal picked
            out = np.empty((len(h), BANDS + MEMBERS), np.float32)
            for b, s in parts:
                np.matmul(g[s], outputs[b], out=out[s])
            if at is not None:
                picked = np.minimum(out.reshape(-1)[at], _MOST)
            return out

        d, total = _exp(logits, MEMBERS)
        return z, g, d, total, picked

    def _places(self, y: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]], np.ndarray]:
        """An order of the ids by band, each band's rows in it, and where the two logits of each id stand among all, in that order."""
        band = self.vocabulary.band[y]
        order, parts = by_band(band)
        at = np.arange(0, len(y) * (BANDS + MEMBERS), MEMBERS)
        at[0::2] += band[order]
        at[1::2] += self.vocabulary.member[y[order]]
        return order, parts, at

    def train_step(self, x: np.ndarray, y: np.ndarray, live: np.ndarray, rate: float, state: dict, told: bool = True) -> float | None:
        """One step on the ids y of all positions of the windows x; returns the mean loss in nats, if it is to be told. Adam, but AdaGrad by row for the embeddings."""
        p, grad = self.p, {}
        rows = x.reshape(-1)
        e = np.take(p["E"], rows, axis=0)
        shape = (*x.shape, 3 * DIM)
        projections = np.concatenate([p["Wq"], p["Wkv"]], axis=1)
        q, k, v = np.split((e @ projections).reshape(shape), 3, axis=2)
        bias, distance, ahead = self._bias(WINDOW)
        h, a = self._attended(q, k, v, bias)
        h += e

        y, live = y.reshape(-1), live.reshape(-1)
        order, parts, at = self._places(y)
        weight = (live / max(1, int(live.sum()))).astype(np.float32)
        weight = np.repeat(weight[order], 2)
        h, outputs = np.take(h, order, axis=0), self._outputs()
        z, g, d, total, picked = self._exponentials(h, parts, outputs, at if told else None)
        loss = float((np.log(total) - picked) @ weight) if told else None
        by_half = d.reshape(-1, MEMBERS)
        by_half *= (weight / total)[:, None]
        d.reshape(-1)[at] -= weight
        both = np.zeros_like(outputs)
        dg = np.empty_like(h)
        for b, s in parts:
            np.matmul(g[s].T, d[s], out=both[b])
            np.matmul(d[s], outputs[b, :DIM].T, out=dg[s])
        grad["U1"], grad["U2"] = both[:, :, :BANDS].sum(0), both[:, :, BANDS:]
        grad["W2"] = z.T @ dg
        dz = dg @ p["W2"].T
        dz *= z > 0
        grad["W1"] = h.T @ dz
        dg += dz @ p["W1"].T
        dh = np.empty_like(dg)
        dh[order] = dg
        do = dh.reshape(*x.shape, DIM)
        d = np.empty(shape, np.float32)
        np.matmul(a.transpose(0, 2, 1), do, out=d[..., 2 * DIM :])
        da = do @ v.transpose(0, 2, 1)
        da -= np.einsum("bst,bst->bs", da, a)[..., None]
        da *= a
        far = (np.ones(len(da), np.float32) @ da.reshape(len(da), -1)).reshape(ahead.shape)
        grad["far"] = np.bincount(distance[~ahead], far[~ahead], WINDOW).astype(np.float32)
        np.matmul(da, k, out=d[..., :DIM])
        np.matmul(da.transpose(0, 2, 1), q, out=d[..., DIM : 2 * DIM])
        flat = d.reshape(-1, 3 * DIM)
        grad["Wq"], grad["Wkv"] = np.split(e.T @ flat, [DIM], axis=1)
        dh += flat @ projections.T

        t = state["t"] = state.get("t", 0) + 1
        flat = np.concatenate([x.reshape(-1) for x in grad.values()])
        at = np.cumsum([0, *(x.size for x in grad.values())]).tolist()
        cut = lambda x: {name: x[b:e].reshape(gr.shape) for (name, gr), b, e in zip(grad.items(), at[:-1], at[1:], strict=True)}
        if "moments" not in state:
            m, r = state["moments"] = np.zeros((2, len(flat)), np.float32)
            first, second = cut(m), cut(r)
            state |= {name: (first[name], second[name]) for name in grad}
        m, r = state["moments"]
        m += 0.1 * (flat - m)
        r += 0.01 * (flat * flat - r)
        for name, by in cut(np.float32(rate / (1 - 0.9**t)) * m / (np.sqrt(r / np.float32(1 - 0.99**t)) + np.float32(1e-8))).items():
            p[name] -= by
        order = np.argsort(rows.astype(np.min_scalar_type(len(p["E"]) - 1)), kind="stable")
        rows = rows[order]
        begin = np.flatnonzero(np.diff(rows, prepend=rows.dtype.type(0) if rows[0] else rows.dtype.type(1)))
        used, de = rows[begin], np.add.reduceat(np.take(dh, order, axis=0), begin, axis=0)
        square = state.setdefault("E", np.zeros(len(p["E"]), np.float32))
        square[used] += np.einsum("ud,ud->u", de, de) / DIM
        p["E"][used] -= de * (np.float32(5 * rate) / (np.sqrt(square[used]) + np.float32(1e-8)))[:, None]
        return loss

    def train(self, ids: np.ndarray, lengths: np.ndarray, least: int, rate: float, state: dict, seed: int = 11) -> None:
        """Every window once, and again until ``state`` has seen ``least`` steps."""
        if not len(ids):
            return
        x, place, live = windows(ids, lengths, WINDOW)
        y = ids[place]
        rng = np.random.default_rng(seed)
        while True:
            order = rng.permutation(len(x))
            for k in range(0, len(x), STEP):
                pick = order[k : k + STEP]
                self.train_step(x[pick], y[pick], live[pick], rate, state, told=False)
            if state["t"] >= least:
                return

    def copy(self) -> Model:
        other = copy(self)
        other.p = {k: v.copy() for k, v in self.p.items()}
        return other

    def packed(self) -> np.ndarray:
        return np.concatenate([v.reshape(-1) for v in self.p.values()])

    def unpack(self, flat: np.ndarray) -> None:
        """The parameters from one flat array in the order of :meth:`packed`."""
        at = 0
        for k, v in self.p.items():
            self.p[k] = flat[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """What each symbol brings to a scored position, and to those that see it."""
        e = self.p["E"]
        return np.concatenate([e, e @ self.p["Wq"]], axis=1), e @ self.p["Wkv"]

    def score(self, ids: np.ndarray, lengths: np.ndarray, tables: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Natural log probability of each id given those before it in its document; ``tables`` may be kept from call to call."""
        out = np.zeros(len(ids), np.float32)
        if not len(ids):
            return out
        bias, outputs = self._bias(STRIDE)[0], self._outputs()
        own_table, seen_table = tables or self.tables()
        x, place, live = windows(ids, lengths, STRIDE)
        for at in range(0, len(x), CHUNK):
            part = slice(at, at + CHUNK)
            own = np.take(own_table, x[part, -STRIDE:], axis=0)
            seen = np.take(seen_table, x[part], axis=0)
            h = self._attended(own[..., DIM:], seen[..., :DIM], seen[..., DIM:], bias)[0]
            h += own[..., :DIM].reshape(-1, DIM)
            y = ids[place[part].reshape(-1)]
            order, parts, spots = self._places(y)
            total, picked = self._exponentials(np.take(h, order, axis=0), parts, outputs, spots)[3:]
            picked -= np.log(total)
            got = self.vocabulary.inside[y]
            got[order] += picked[0::2] + picked[1::2]
            inside = live[part].reshape(-1)
            out[place[part].reshape(-1)[inside]] = got[inside]
        return out
