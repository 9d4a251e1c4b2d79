"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A trigram's vector binds (multiplies) its
letters' vectors, permuted by their places; a text's vector bundles (adds) its trigrams'.
A language's prototype bundles the trigrams of all its training documents. Documents are
compared with the prototypes by cosine. Bundling is linear, so texts are counted by
trigram first and bound vectors are made once per distinct trigram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bursa.llm.common import doc_texts, id_fold, rows_of, sliced

DIMS = 512
SYMBOLS = 64  # space, a-z, and 37 classes that all other letters fall into by code point
SEED = 10
FOLDS, HELD_FOLD = 3, 1
BLOCK_DOCS = 64
BLOCK_CHARS = 1 << 20
UNKNOWN = "und"
_LAST_LETTER = 0x323B0  # no letter is assigned beyond
_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Each code point's symbol: 0 if it is no letter; upper and lower case are the same."""
    global _letters
    if _letters is None:
        table = np.zeros(_LAST_LETTER, np.uint8)
        for cp in range(_LAST_LETTER):
            if (c := chr(cp)).isalpha():
                low = ord(c.lower()[0])
                table[cp] = low - 96 if 97 <= low <= 122 else 27 + low % (SYMBOLS - 27)
        _letters = table
    return _letters


def letter_vectors() -> np.ndarray:
    """(place, symbol, dimension): the vector of each symbol, rolled by its place."""
    v = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (SYMBOLS, DIMS))
    return np.stack([np.roll(v, k, axis=1) for k in (2, 1, 0)])


def trigrams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigram codes and their counts; words are set apart by one space."""
    table, found = letter_table(), []
    whole = text.decode()
    tail = np.zeros(1, np.int32)  # the last two symbols so far, of which trigrams of the next block begin
    for at in range(0, len(whole), BLOCK_CHARS):
        cp = np.frombuffer(whole[at:at + BLOCK_CHARS].encode("utf-32-le"), "<u4")
        s = (table[np.minimum(cp, _LAST_LETTER - 1)] * (cp < _LAST_LETTER)).astype(np.int32)
        s = np.concatenate((tail, s, np.zeros(int(at + BLOCK_CHARS >= len(whole)), np.int32)))
        s = s[np.concatenate((np.ones(len(tail), bool), (s[len(tail):] != 0) | (s[len(tail) - 1:-1] != 0)))]
        if len(s) >= 3:
            found.append(np.unique((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], return_counts=True))
        tail = s[-2:]
    if len(found) == 1:
        return found[0]
    total = np.zeros(SYMBOLS ** 3, np.int64)
    for codes, n in found:
        total[codes] += n
    codes = np.flatnonzero(total)
    return codes, total[codes]


def bound(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The bound vectors of trigrams."""
    a, b, c = codes // SYMBOLS ** 2, codes // SYMBOLS % SYMBOLS, codes % SYMBOLS
    return letters[0][a] * letters[1][b] * letters[2][c]


def bundle(text: bytes, letters: np.ndarray) -> np.ndarray:
    """The text's vector; zero if it has no letter."""
    codes, n = trigrams(text)
    out = np.zeros(DIMS, np.float32)
    for at in range(0, len(codes), 4096):
        out += n[at:at + 4096].astype(np.float32) @ bound(codes[at:at + 4096], letters).astype(np.float32)
    return out


def prototypes(docs: DataFrame, folds: int = FOLDS, held: int = HELD_FOLD) -> DataFrame:
    """(lang, at, value): each language's bundle over all training documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in sliced(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                codes, n = trigrams(text or b"")
                if len(codes):
                    sums.setdefault(lang, np.zeros(SYMBOLS ** 3, np.int64))[codes] += n
        letters = letter_vectors()
        for lang in sorted(sums):
            codes, total = np.flatnonzero(sums[lang]), np.zeros(DIMS, np.int64)
            for at in range(0, len(codes), 4096):
                own = codes[at:at + 4096]
                total += sums[lang][own] @ bound(own, letters).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * DIMS), pa.array(range(DIMS), pa.int32()),
                                              pa.array(total)], ["lang", "at", "value"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"),
                      F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & (id_fold(folds) != held))
    return own.select("text", "lang").mapInArrow(run, "lang string, at int, value long") \
        .groupBy("lang", "at").agg(F.sum("value").alias("value"))


class Model:
    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({r[0] for r in rows})
        m = np.zeros((len(self.langs), DIMS))
        for lang, at, value in rows:
            m[self.langs.index(lang), at] = value
        self.unit = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    def predict(self, texts: list[bytes]) -> Iterator[tuple[str, float]]:
        """Best language and its cosine, negative ones as 0; ties go to the first name."""
        letters = letter_vectors()
        for at in range(0, len(texts), BLOCK_DOCS):
            x = np.array([bundle(t, letters) for t in texts[at:at + BLOCK_DOCS]])
            size = np.linalg.norm(x, axis=1, keepdims=True)
            cosine = (x / np.maximum(size, 1e-9)) @ self.unit.T
            for row, known in zip(cosine, size[:, 0] > 0):
                if known and self.langs:
                    best = int(row.argmax())
                    yield self.langs[best], float(np.clip(row[best], 0, 1))
                else:
                    yield UNKNOWN, 0.0


def identify(docs: DataFrame, folds: int = FOLDS, held: int = HELD_FOLD) -> DataFrame:
    """doc_id, held_out, lang_pred, score per input row.

    Null texts and texts without a letter give ``und`` and 0, as does a table without any
    training document. Documents whose language is null are predicted, not learned from.
    """
    model = docs.sparkSession.sparkContext.broadcast(
        Model([tuple(r) for r in prototypes(docs, folds, held).collect()]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches):
            langs, scores = zip(*model.value.predict(texts))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs), pa.array(scores)],
                                             ["doc_id", "lang_pred", "score"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double").select(
        "doc_id", (id_fold(folds) == held).alias("held_out"), "lang_pred", "score")
