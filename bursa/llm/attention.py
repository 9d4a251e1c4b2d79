"""A small causal self-attention language model in numpy.

A word enters as the mean of the vectors of its subword ids. One attention head, with a
bias per distance, looks at the words before and gives the odds of a few kinds of text;
the next word's probability is the mixture of its shares in those kinds. Shares come from
counts, so the model starts at their mixture, gives every word of its table a positive
probability, and learns from the context which kind is at hand.

Words are numbers of a table: 0 is the end, the last one stands for all rare words.
"""

from __future__ import annotations

import numpy as np

DIMS = 16
HALF = 16  # a window is a half that is scored, and the half before it as context
WINDOW = 2 * HALF
CHUNK = 256  # blocks per batch
ROWS = 64  # of a matrix that are multiplied at once


class Model:
    def __init__(self, subwords: list[np.ndarray], shares: np.ndarray, n_ids: int, dims: int = DIMS, seed: int = 2):
        """subwords: each word's subword ids (rare: none); shares: (kinds, words), rows sum to 1."""
        rng = np.random.default_rng(seed)
        kinds = len(shares)
        self.sizes = np.array([len(x) for x in subwords])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.concatenate([*subwords, np.empty(0, np.int64)]).astype(np.int64)
        self.shares = shares.astype(np.float32)
        # An id's vector starts as the log odds of the kinds that its words stand in.
        whole = np.zeros((n_ids, kinds))
        owner = np.repeat(np.arange(len(subwords)), self.sizes)
        np.add.at(whole, self.flat, shares.T[owner])
        mean = whole.mean(1, keepdims=True)
        odds = np.where(mean > 0, np.log((whole + 0.05 * mean + 1e-12) / (1.05 * mean + 1e-12)), 0)
        ids = 0.02 * rng.standard_normal((n_ids, dims))
        ids[:, :kinds] += 0.5 * odds.clip(-3, 3)
        square = lambda scale: (scale * rng.standard_normal((dims, dims))).astype(np.float32)
        out = 0.05 * rng.standard_normal((dims, kinds))
        out[:kinds] += 4 * np.eye(kinds)
        self.p = {"wq": square(0.1), "wk": square(0.1), "wv": np.eye(dims, dtype=np.float32) + square(0.02),
                  "wo": square(0.02), "near": np.linspace(0, -1, WINDOW, dtype=np.float32),  # by distance
                  "ids": ids.astype(np.float32), "kinds": out.astype(np.float32), "prior": np.zeros(kinds, np.float32)}
        self.scale = np.float32(1 / np.sqrt(dims))

    def vectors(self, words: np.ndarray) -> np.ndarray:
        """The mean of the words' subword vectors; rare words have none and are zero."""
        n = self.sizes[words]
        rows = np.repeat(np.arange(len(words)), n)
        at = np.arange(len(rows)) + np.repeat(self.starts[words] - (np.cumsum(n) - n), n)
        out = np.zeros((len(words), self.p["ids"].shape[1]), self.p["ids"].dtype)
        full = np.flatnonzero(n)
        if len(full):
            sums = np.add.reduceat(self.p["ids"].take(self.flat[at], 0), (np.cumsum(n) - n)[full])
            out[full] = sums / n[full, None]
        return out

    def _bias(self) -> np.ndarray:
        """Distance bias of (query in a window, key in it); later keys are shut out."""
        d = np.arange(WINDOW)[:, None] - np.arange(WINDOW)
        return np.where(d >= 0, self.p["near"][np.abs(d)], np.float32(-1e9)).astype(np.float32)

    def _chances(self, h: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Odds of the kinds, the targets' shares in them, and the targets' probabilities."""
        z = _times(h, self.p["kinds"]) + self.p["prior"]
        if len(z) and float(np.abs(z).max()) > 60:  # else no exponential overflows
            z -= z.max(1, keepdims=True)
        g = np.exp(z, out=z)
        g /= _totals(g)
        own = self._by_word().take(targets, 0)
        return g, own, np.einsum("ij,ij->i", g, own)

    def _by_word(self) -> np.ndarray:
        if "_rows" not in self.__dict__:
            self._rows = np.ascontiguousarray(self.shares.T)
        return self._rows

    def score(self, docs: list[np.ndarray], table: np.ndarray | None = None) -> np.ndarray:
        """Log10 probability of each word sequence (each ends with the end, 0).

        Sequences are laid out in blocks of HALF after one empty block each; a block's
        words are scored once, with the block before as context. ``table``: the vectors
        of all words, where they are needed many times."""
        table = self.vectors(np.arange(len(self.sizes))) if table is None else table
        sizes = np.array([len(d) for d in docs])
        blocks = -(-sizes // HALF) + 1
        first = np.cumsum(blocks) - blocks
        total = int(blocks.sum())
        at = np.arange(int(sizes.sum())) + np.repeat((first + 1) * HALF - (np.cumsum(sizes) - sizes), sizes)
        target = np.full(total * HALF, -1, np.int64)
        target[at] = np.concatenate(docs)
        given = np.roll(np.maximum(target, 0), 1)
        given[(first + 1) * HALF] = 0
        target, given = target.reshape(-1, HALF), given.reshape(-1, HALF)
        real = np.ones(total, bool)
        real[first] = False
        b, alone = np.flatnonzero(real), np.zeros(total, bool)
        alone[first + 1] = True
        bias, out = self._bias()[HALF:], np.zeros(len(docs))
        doc_of = np.repeat(np.arange(len(docs)), blocks)
        p, dims = self.p, self.p["wq"].shape[0]
        mixed = np.concatenate((p["wq"] * self.scale, p["wk"], p["wv"], p["wo"]), axis=1)
        for k in range(0, len(b), CHUNK):
            own = b[k:k + CHUNK]
            low = own[0] - 1  # blocks from here on, each made once; the one before is a block's context
            y = _times(table.take(given[low:own[-1] + 1].ravel(), 0), mixed)
            y = y.reshape(-1, HALF, 4 * dims)
            now, before = y.take(own - low, 0), y.take(own - 1 - low, 0)
            e = now[:, :, :dims] @ np.concatenate(
                (before[:, :, dims:2 * dims], now[:, :, dims:2 * dims]), axis=1).transpose(0, 2, 1)
            e += bias
            e[alone[own], :, :HALF] = -1e9
            if float(e.max()) > 60:  # else no exponential overflows
                e -= e.max(-1, keepdims=True)
            np.exp(e, out=e)
            mean = e @ np.concatenate((before[:, :, 2 * dims:3 * dims], now[:, :, 2 * dims:3 * dims]), axis=1)
            mean /= _totals(e)
            h = np.tanh(now[:, :, 3 * dims:] + mean).reshape(-1, dims)
            t = target[own].ravel()
            known = np.flatnonzero(t >= 0)
            chance = self._chances(h if len(known) == len(h) else h.take(known, 0), t[known])[2]
            each = np.log10(np.maximum(chance, 1e-30), dtype=np.float64)
            out += np.bincount(doc_of[own].repeat(HALF)[known], each, len(docs))
        return out

    def gradients(self, window: np.ndarray) -> tuple[dict, float]:
        """Gradients over windows of WINDOW + 1 words, and the loss in nats.

        Words below 0 fill up a window's end: they are no targets, and no target sees them."""
        p, given, t = self.p, np.maximum(window[:, :-1], 0), window[:, 1:].ravel()
        known = np.flatnonzero(t >= 0)
        words, place = np.unique(given, return_inverse=True)
        place = place.ravel()
        flat = lambda y: y.reshape(-1, y.shape[-1])
        x = self.vectors(words).take(place, 0)
        weights = np.concatenate((p["wq"], p["wk"], p["wv"], p["wo"]), axis=1)
        q, k, v, straight = np.split(_times(x, weights).reshape(*given.shape, -1), 4, axis=2)
        s = q @ k.transpose(0, 2, 1)
        s *= self.scale
        large = float(np.abs(s).max(initial=0)) + float(np.abs(p["near"]).max()) > 60  # else no exponential overflows
        s += self._bias()
        if large:
            s -= s.max(-1, keepdims=True)
        a = np.exp(s, out=s)
        a /= _totals(a)
        h = np.tanh(straight + a @ v)
        own = flat(h).take(known, 0)
        g, shares, chance = self._chances(own, t[known])
        loss = float(-np.log(np.maximum(chance, 1e-30)).sum())
        dz = g - g * shares / np.maximum(chance, 1e-30)[:, None]
        dh = np.zeros_like(flat(h))
        dh[known] = _times(dz, p["kinds"].T)
        dh = dh.reshape(h.shape) * (1 - h * h)
        da = dh @ v.transpose(0, 2, 1)
        ds = a * (da - np.einsum("bij,bij->bi", da, a)[:, :, None])
        dv, dq = a.transpose(0, 2, 1) @ dh, ds @ k * self.scale
        dk = ds.transpose(0, 2, 1) @ q * self.scale
        each = np.concatenate((flat(dq), flat(dk), flat(dv), flat(dh)), axis=1)
        dx = _times(each, weights.T)
        dweights = np.split(_inner(x, each), 4, axis=1)
        d = np.arange(WINDOW)[:, None] - np.arange(WINDOW)
        grads = dict(zip(("wq", "wk", "wv", "wo"), dweights)) | {
                 "kinds": _inner(own, dz), "prior": dz.sum(0),
                 "near": np.bincount(d[d >= 0], ds.sum(0)[d >= 0], WINDOW).astype(np.float32)}
        n = self.sizes[words]
        dwords = _added(place, dx, len(words)) / np.maximum(n, 1)[:, None]
        rows = np.repeat(np.arange(len(words)), n)
        at = np.arange(len(rows)) + np.repeat(self.starts[words] - (np.cumsum(n) - n), n)
        ids, of = np.unique(self.flat[at], return_inverse=True)
        grads["ids"] = ids, _added(of, dwords.take(rows, 0), len(ids)).astype(dx.dtype)
        return grads, loss


def _totals(x: np.ndarray) -> np.ndarray:
    """Sums over the last axis, which stays; short rows add up faster as a product."""
    ones = np.ones((x.shape[-1], 1), x.dtype)
    return _times(x, ones) if x.ndim == 2 else x @ ones


def _times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x @ y, some rows at a time: for larger products numpy's library wakes threads of its
    own, which wait busily and take more time than they save where each core has its task."""
    full = len(x) // ROWS * ROWS
    some = x[:full].reshape(-1, ROWS, x.shape[1]) @ y
    return np.concatenate((some.reshape(full, y.shape[1]), x[full:] @ y))


def _inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x.T @ y, some rows at a time as in ``_times``."""
    full = len(x) // ROWS * ROWS
    a, b = (z[:full].reshape(-1, ROWS, z.shape[1]) for z in (x, y))
    return (a.transpose(0, 2, 1) @ b).sum(0) + x[full:].T @ y[full:]


def _added(place: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of each place below ``n``, column by column."""
    return np.stack([np.bincount(place, column, n) for column in np.ascontiguousarray(rows.T)], axis=1)


def summed(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their rows."""
    if not len(keys):
        return keys, rows
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.diff(keys[order], prepend=-1))
    return keys[order][first], np.add.reduceat(rows.take(order, 0), first)


class Trainer:
    """Adagrad on a model's own copy of the parameters."""

    def __init__(self, model: Model, rate: float):
        self.model, self.rate = model, np.float32(rate)
        model.p = {k: v.copy() for k, v in model.p.items()}
        self.start = {k: v.copy() for k, v in model.p.items()}
        self.square = {k: np.full_like(v, 1.0) for k, v in model.p.items()}
        self.windows = 0

    def step(self, window: np.ndarray) -> float:
        grads, loss = self.model.gradients(window)
        for name, g in grads.items():
            at, g = g if name == "ids" else (slice(None), g)
            self.square[name][at] += g * g
            self.model.p[name][at] -= self.rate * g / np.sqrt(self.square[name][at])
        self.windows += len(window)
        return loss

    def changes(self):
        """(name, row, change) of what has moved; a dense matrix counts row by row."""
        for name, v in self.model.p.items():
            change = v - self.start[name]
            change = change if change.ndim == 2 else change[:, None]
            for row in np.flatnonzero(np.abs(change).max(1) > 0):
                yield name, int(row), change[row]
