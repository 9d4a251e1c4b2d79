"""Quality rules: counted base rules and a hashed n-gram logistic regression.

The regression runs on hashed character trigrams and hashed words and word pairs. It is
trained on a bounded sample of labelled rows, calibrated on rows it was not trained on
(Platt scaling), broadcast as one weight vector, and scored in Arrow batches against a
fixed probability.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bursa.llm import features as X
from bursa.llm.common import doc_texts, rows_of
from bursa.llm.quality_knn import labelled_texts

MAX_LABELLED = 4000
HASH_DIMS = 4096
KEEP = 0.3  # calibrated probability of quality
FOLDS = 5  # rows of fold 0 are never trained on
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
_SYMBOLS = re.compile(rb"[#*$%&|<>]")


def counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    ids, size = X.word_numbers(text)
    # Continuation bytes only occur inside words, so code points are bytes less these.
    size -= int(((np.frombuffer(text, np.uint8) & 0xC0) == 0x80).sum()) if not text.isascii() else 0
    return len(ids), size, len(_SYMBOLS.findall(text)), X.duplicate_lines(text), X.repeated_words(ids, WINDOW)


def failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


def features(text: bytes) -> np.ndarray:
    """Square roots of hashed n-gram counts at unit length, and a constant."""
    x = np.sqrt(X.hashed_ngrams(text, HASH_DIMS))
    for half in (x[:HASH_DIMS // 2], x[HASH_DIMS // 2:]):
        half /= max(1.0, float(np.linalg.norm(half)))
    return np.append(x, np.float32(1))


def _logistic(x: np.ndarray, y: np.ndarray, l2: float, rounds: int) -> np.ndarray:
    """Weights by accelerated gradient descent; both classes weigh the same."""
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())).astype(np.float32)
    w = v = np.zeros(x.shape[1], np.float32)
    step = np.float32(1 / (0.25 * 3 + l2))  # rows have length sqrt(3)
    for k in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        new = v - step * (x.T @ (share * (p - y)) + l2 * v)
        v, w = new + (k / (k + 3)) * (new - w), new
    return w


class Model:
    def __init__(self, x: np.ndarray, y: np.ndarray, l2: float = 1e-5, rounds: int = 600):
        self.w, self.a, self.b = np.zeros(HASH_DIMS + 1, np.float32), 1.0, 0.0
        self.constant = None
        if len(set(y.tolist())) < 2:  # one class or none: nothing to learn
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        y = y.astype(np.float32)
        spare = np.arange(len(y)) % 4 == 0
        self.w = _logistic(x[~spare], y[~spare], l2, rounds)
        z, t = x[spare] @ self.w, y[spare]
        # Platt's targets keep the two calibration parameters finite.
        t = np.where(t == 1, (t.sum() + 1) / (t.sum() + 2), 1 / (len(t) - t.sum() + 2))
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            g, s = p - t, np.maximum(p * (1 - p), 1e-6)
            h = np.array([[(s * z * z).sum() + 1e-3, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-3]])
            da, db = np.linalg.solve(h, [(g * z).sum() + 1e-3 * (a - 1), g.sum()])
            a, b = a - da, b - db
        self.a, self.b = (float(a), float(b)) if a > 0 else (1.0, 0.0)

    def probability(self, x: np.ndarray) -> float:
        if self.constant is not None:
            return self.constant
        return float(1 / (1 + np.exp(-np.clip(self.a * float(x @ self.w) + self.b, -30, 30))))


def train(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, limit: int = MAX_LABELLED) -> Model:
    """Fit on at most ``limit`` labelled documents; their vectors (bounded) reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches):
            for at in range(0, len(ids), 256):
                x = [features(t).astype(np.float16).tobytes() for t in texts[at:at + 256]]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at:at + 256], pa.int64()), pa.array(x, pa.binary())],
                                                 ["doc_id", "x"])

    sample, label = labelled_texts(docs, labels, folds, limit)
    rows = sample.mapInArrow(run, "doc_id long, x binary").orderBy("doc_id", "x").limit(2 * limit).collect()
    x = np.empty((len(rows), HASH_DIMS + 1), np.float32)
    for k, r in enumerate(rows):
        x[k] = np.frombuffer(r["x"], np.float16)
    return Model(x, np.array([label[r["doc_id"]] for r in rows]))


def judge(docs: DataFrame, labels: DataFrame, keep: float = KEEP, folds: int = FOLDS) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    probability; one row per input row.

    A null or empty text has no words and fails. Without labels of both classes the
    probability is the labels' mean (0.5 without labels), so base rules decide alone.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, folds))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for ids, texts in rows_of(batches):
            rows = [counts(t) for t in texts]
            bad = [failed(r[0], r[4]) for r in rows]
            p = [m.probability(features(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in zip(*rows)), pa.array(bad),
                 pa.array([not b and q >= keep for b, q in zip(bad, p)]), pa.array(p, pa.float64())],
                ["doc_id", *names, "base_failed", "kept", "probability"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in names)
                                      + ", base_failed boolean, kept boolean, probability double")
