"""Byte-level BPE encoding and decoding over Arrow batches.

Text becomes bytes, bytes become the vocabulary's characters, and the tokenizers
library's BPE model merges each match of the split pattern; decoding reverses the byte
table on the concatenated tokens, so a character that several tokens share comes back
whole. Offsets follow from the tokens' byte lengths and the text's byte-to-character map.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from bursa.llm.bpe import Shared, from_ranks, read_ranks
from bursa.llm.common import doc_texts, give_back, rows_of

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def shared_codec(docs: DataFrame, ranks_path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> Shared:
    return Shared(docs.sparkSession, from_ranks(read_ranks(ranks_path)), pattern)


def encode(docs: DataFrame, codec: Shared) -> DataFrame:
    """doc_id, ids (little-endian uint32 bytes), n_tokens, n_split; one row per input row.

    n_split counts tokens that begin inside a character. A null text is empty: no ids.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec.get()
        for ids, texts in rows_of(batches):
            out = c.encode_each(texts)
            counts = [[len(x) for x in out], [c.splits(x, t) for x, t in zip(out, texts)]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([x.tobytes() for x in out], pa.binary()), *(pa.array(x, pa.int64()) for x in counts)],
                ["doc_id", "ids", "n_tokens", "n_split"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, ids binary, n_tokens long, n_split long")


def encode_with_offsets(docs: DataFrame, codec: Shared) -> DataFrame:
    """doc_id, ids, byte_starts, char_starts, char_ends (arrays, one entry per token)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec.get()
        for ids, texts in rows_of(batches):
            cols: list[list] = [[], [], [], []]
            for x, t in zip(c.encode_each(texts), texts):
                ends, first, last = c.offsets(x, t)
                row = (x, np.concatenate(([0], ends[:-1])) if len(ends) else ends, first, last)
                for col, v in zip(cols, row):
                    col.append(v.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(col, pa.list_(pa.int64())) for col in cols)],
                ["doc_id", "ids", "byte_starts", "char_starts", "char_ends"])

    arrays = ", ".join(f"{c} array<long>" for c in ("ids", "byte_starts", "char_starts", "char_ends"))
    return doc_texts(docs).mapInArrow(run, f"doc_id long, {arrays}")


def decode(encoded: DataFrame, codec: Shared) -> DataFrame:
    """Adds ``decoded`` (bytes) to rows of ``encode``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec.get()
        for batch in batches:
            out = [c.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, "doc_id long, ids binary, n_tokens long, n_split long, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_split of every row, repeated rows too.

    A null or empty text has no ids and decodes to nothing. Encoding and decoding are one
    step, so that a task needs one Python worker and one codec for both."""
    codec = shared_codec(docs, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec.get()
        for ids, texts in rows_of(batches):
            out = [x.tobytes() for x in c.encode_each(texts)]
            splits = [c.splits(np.frombuffer(x, "<u4"), t) for x, t in zip(out, texts)]
            decoded = [c.decode(x) for x in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(x) // 4 for x in out], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in out]),
                 pa.array([hashlib.sha256(x).hexdigest() for x in decoded]), pa.array(splits, pa.int64())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_split"])
        give_back()

    return doc_texts(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_split long")
