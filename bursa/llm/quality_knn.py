"""Quality by nearest-neighbour voting in a latent-semantic space.

A document's features are the tf-idf weights of its hashed words and character trigrams,
with document frequencies counted over all documents, and as extra columns byte-class
trigram and repetition shares. The matrix of a bounded sample of labelled documents is
decomposed by a truncated SVD; the labelled vectors, bounded by the sample, are broadcast.
Every document is projected, compared with all labelled
vectors in one blocked matrix product, and scored by its nearest neighbours' labels
weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bursa.llm import features as X
from bursa.llm.common import doc_texts, give_back, id_fold, rows_of, text_slices

MAX_LABELLED = 4000  # labelled documents with the smallest id hashes
DIMS = 32
NEIGHBOURS = 15
THRESHOLD = 0.3
FOLDS = 5  # rows of fold 0 are held out
BLOCK_DOCS = 256
TERMS = 8192  # a quarter for character trigrams, the rest for words
TERM_WEIGHT = 1.0  # length of the words' vector, and of the trigrams'; that of the shape shares is 1
# Repetition shares weigh as much as a trigram class that makes up so much of the text.
REPEAT_WEIGHT = 4.0


def features(text: bytes, idf: np.ndarray) -> np.ndarray:
    """tf-idf of trigrams and words, square roots of byte-class trigram shares, then
    repeated-window, repeated-line and same-word shares."""
    terms = np.log1p(X.hashed_terms(text, len(idf))) * idf
    for part in (terms[:len(idf) // 4], terms[len(idf) // 4:]):
        part *= TERM_WEIGHT / max(1e-9, float(np.linalg.norm(part)))
    grams = X.shape_trigrams(text).astype(np.float32)
    ids, _ = X.word_numbers(text)
    n, lines = max(1, len(ids)), max(1, text.count(b"\n") + 1)
    shares = [X.repeated_words(ids) / n, X.duplicate_lines(text) / lines, (np.diff(ids) == 0).sum() / n]
    return np.concatenate((terms, np.sqrt(grams / max(1.0, grams.sum())), np.array(shares, np.float32) * REPEAT_WEIGHT))


def inverse_frequencies(docs: DataFrame, terms: int = TERMS) -> np.ndarray:
    """log((documents + 1) / (documents with the term + 1)) + 1 per hashed term, over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(terms + 1, np.int64)  # the last one: rows
        for _, texts in rows_of(batches):
            n[-1] += len(texts)
            for text in texts:
                n[:-1] += X.hashed_terms(text, terms) > 0
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at])], ["term", "n"])

    n = np.zeros(terms + 1)
    for r in doc_texts(docs).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        n[r["term"]] = r["n"]
    return (np.log((n[-1] + 1) / (n[:-1] + 1)) + 1).astype(np.float32)


def labelled(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, label) of at most ``limit`` labelled documents outside fold 0.

    Several labels of a document are averaged; null ids and labels don't count."""
    own = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    return own.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi") \
        .where(id_fold(folds) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def labelled_texts(docs: DataFrame, labels: DataFrame, folds: int, limit: int) -> tuple[DataFrame, dict[int, int]]:
    """The documents of the labelled sample, and its labels by id (at most ``limit``)."""
    label = {r["doc_id"]: r["label"] for r in labelled(docs, labels, folds, limit).collect()}
    one = docs.sparkSession.createDataFrame([(i,) for i in sorted(label)], "sample_id long")
    texts = doc_texts(docs)
    return texts.join(F.broadcast(one), texts.doc_id == one.sample_id, "left_semi"), label


def right_vectors(x: np.ndarray, dims: int, rounds: int = 6, seed: int = 7) -> np.ndarray:
    """The first right singular vectors by subspace iteration; no square matrix is made."""
    dims = min(dims, *x.shape)
    q = np.random.default_rng(seed).standard_normal((x.shape[1], min(dims + 16, *x.shape))).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return np.ascontiguousarray((q @ v.T)[:, :dims], np.float32)


class Model:
    def __init__(self, x: np.ndarray, y: np.ndarray, idf: np.ndarray, dims: int = DIMS):
        """x: features of the labelled rows; y: labels; idf: weights of the terms."""
        self.idf = idf
        self.y, self.prior = y.astype(np.float32), float(y.mean()) if len(y) else 0.5
        if len(y):
            self.basis = right_vectors(x, dims)
            self.points = unit(x @ self.basis)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Mean label of the nearest neighbours, weighted by similarity; ties at the last
        place all count. No labelled row: 0.5; no positive similarity: the labels' mean."""
        if not len(self.y):
            return np.full(len(x), 0.5)
        cosine = unit(x @ self.basis) @ self.points.T
        k = min(NEIGHBOURS, len(self.y))
        last = -np.partition(-cosine, k - 1, axis=1)[:, k - 1:k]
        weight = np.where(cosine >= last, np.maximum(cosine, 0) ** 8, 0).astype(np.float64)
        total = weight.sum(1)
        return np.where(total > 0, weight @ self.y / np.maximum(total, 1e-12), self.prior).clip(0, 1)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def train(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, limit: int = MAX_LABELLED,
          dims: int = DIMS) -> Model:
    shared = docs.sparkSession.sparkContext.broadcast(inverse_frequencies(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches):
            for at in range(0, len(ids), BLOCK_DOCS):
                x = [_packed(features(t, shared.value)) for t in texts[at:at + BLOCK_DOCS]]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at:at + BLOCK_DOCS], pa.int64()),
                                                  pa.array(x, pa.binary())], ["doc_id", "x"])

    sample, label = labelled_texts(docs, labels, folds, limit)
    rows = sample.mapInArrow(run, "doc_id long, x binary").orderBy("doc_id", "x").limit(2 * limit).toLocalIterator()
    x, y = [], []
    for r in rows:
        x.append(bytes(r["x"]))
        y.append(label[r["doc_id"]])
    size = len(features(b"", shared.value))
    full = np.zeros((len(x), size), np.float32)
    for k, data in enumerate(x):
        entries = np.frombuffer(data, _ENTRY)
        full[k, entries["at"]] = entries["x"]
    return Model(full, np.array(y), shared.value, dims)


_ENTRY = np.dtype([("at", "<u2"), ("x", "<f2")])


def _packed(x: np.ndarray) -> bytes:
    """The non-zero features and their places."""
    at = np.flatnonzero(x)
    out = np.empty(len(at), _ENTRY)
    out["at"], out["x"] = at, x[at]
    return out.tobytes()


def _scores(model: Model, texts: list[bytes]) -> np.ndarray:
    out = [model.scores(np.array([features(t, model.idf) for t in texts[at:at + BLOCK_DOCS]]))
           for at in range(0, len(texts), BLOCK_DOCS)]
    return np.concatenate(out) if out else np.empty(0)


def score(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted per input row.

    A null text counts as empty; an empty text has no features and gets the labels' mean.
    Without any labelled row every score is 0.5. Repeated rows give repeated result rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, folds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(_scores(model.value, texts))],
                                             ["doc_id", "score"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, score double").select(
        "doc_id", (id_fold(folds) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are predicted to be of quality, all columns kept.

    Null and empty texts are judged as ``score`` judges them; repeated rows stay or go
    together; an empty table stays empty."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, folds))

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        out = [_scores(model.value, part) for part in text_slices(texts)]
        give_back()
        return pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())

    return docs.where(scored(F.col("text").cast("string").cast("binary")) >= threshold)
