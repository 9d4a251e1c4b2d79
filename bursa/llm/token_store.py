"""Token-id files: zstandard frames per document under one shared dictionary.

Format. A store is a folder with two Parquet tables, written by Spark so that any file
system Spark knows will do. ``dictionary`` has one row: the dictionary's bytes and their
SHA-256. ``shards`` has rows of about ``SHARD_BYTES``, in ascending doc_id order:
``part`` (write task), ``shard`` (within the part), ``first_id``/``last_id``,
``start`` (ids before the shard within its part), ``n_tokens`` and ``blob``:

    magic 8 bytes | dictionary SHA-256 32 bytes | id width u32 | documents n u32
    n + 1 frame offsets u64 | n doc ids i64 | n null flags u8 | n id counts u64 | frames

Each document is one zstandard frame, so one document is read by its offset alone.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bursa.llm.bpe import Shared
from bursa.llm.common import doc_texts, rows_of

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
SHARD_BYTES = 1 << 20
BATCH_BYTES = 8 << 20  # of text whose distinct parts are encoded together
MEMO = 300_000
LEVEL = 3
# The dictionary is trained on at most so many documents (smallest hashes), of a long one on so many characters.
SAMPLE_DOCS, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 8000, 64 << 10
MAGIC = b"TOKSHRD1"
_HEAD = struct.Struct("<8s32sII")
_ROW = "part int, shard int, first_id long, last_id long, start long, n_tokens long, blob binary"


def shared_codec(docs: DataFrame, path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> Shared:
    with open(path, encoding="utf-8") as f:
        return Shared(docs.sparkSession, f.read(), pattern, MEMO)


def pack_ids(ids: np.ndarray, width: int, end_id: int) -> bytes:
    whole = np.append(ids, np.uint32(end_id))
    return whole.astype(f"<u{width}").tobytes()


def train_dictionary(docs: DataFrame, codec: Shared, width: int, end_id: int = END_ID) -> bytes:
    """A dictionary from a bounded sample; empty if there is too little to train on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec.get()
        for ids, texts in rows_of(batches):
            packed = [pack_ids(x, width, end_id) for x in c.encode_each(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], ["packed"])

    # First the hashes alone, then the texts of the smallest ones: no task gathers texts of all others.
    rows = docs.where(F.length("text") > 0).withColumn("hash", F.xxhash64("doc_id", "text"))
    last = rows.select("hash").orderBy("hash").limit(SAMPLE_DOCS).agg(F.max("hash")).first()[0]
    if last is None:
        return b""
    place = F.pmod("hash", F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS + 1)).cast("int") + 1
    piece = F.substring(F.col("text"), place, F.lit(SAMPLE_CHARS))
    sample = rows.where(F.col("hash") <= last).select("doc_id", piece.alias("text"), "hash") \
        .orderBy("hash", "doc_id", "text").limit(SAMPLE_DOCS)
    sample = doc_texts(sample)
    samples = [bytes(r[0]) for r in sample.mapInArrow(run, "packed binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def _zdict(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def build_blob(frames: list[bytes], ids: list[int | None], counts: list[int], digest: bytes, width: int) -> bytes:
    n = len(frames)
    offsets = np.concatenate(([0], np.cumsum([len(f) for f in frames]))).astype("<u8")
    plain = np.array([i or 0 for i in ids], "<i8")
    null = np.array([i is None for i in ids], np.uint8)
    index = offsets.tobytes() + plain.tobytes() + null.tobytes() + np.array(counts, "<u8").tobytes()
    return b"".join([_HEAD.pack(MAGIC, digest, width, n), index, *frames])


class Shard:
    """A blob's index; ``ids(k)`` decompresses document k alone."""

    def __init__(self, blob: bytes, dictionary: bytes):
        magic, digest, self.width, n = _HEAD.unpack_from(blob)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        at = _HEAD.size
        self.offsets = np.frombuffer(blob, "<u8", n + 1, at)
        plain = np.frombuffer(blob, "<i8", n, at := at + 8 * (n + 1)).tolist()
        null = np.frombuffer(blob, np.uint8, n, at := at + 8 * n)
        self.doc_ids = [None if z else i for i, z in zip(plain, null)]
        self.counts = np.frombuffer(blob, "<u8", n, at := at + n).astype(np.int64)
        self.frames_at = at + 8 * n
        self.blob, self.reader = blob, zstandard.ZstdDecompressor(dict_data=_zdict(dictionary))

    def ids(self, k: int) -> np.ndarray:
        a, b = (self.frames_at + int(x) for x in self.offsets[k:k + 2])
        return np.frombuffer(self.reader.decompress(self.blob[a:b]), f"<u{self.width}").astype("<u4")


def write(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> None:
    """Encode every row (null text: only the end id) into a store, sorted by doc_id.

    Rows with equal ids stay next to each other in the order of their texts' hashes;
    null ids come first. Ids are cut into ranges by doc_id and text hash.
    """
    spark = docs.sparkSession
    codec = shared_codec(docs, vocabulary)
    width = 2 if len(codec.get().table) <= 1 << 16 and end_id < 1 << 16 else 4
    dictionary = train_dictionary(docs, codec, width, end_id)
    digest = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(dictionary, digest.hex())], "dictionary binary, sha256 string") \
        .coalesce(1).write.parquet(f"{path}/dictionary")
    held = spark.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, part = codec.get(), TaskContext.get().partitionId()
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zdict(held.value))
        frames, ids, counts, size, shard, start = [], [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal frames, ids, counts, size, shard, start
            known = [i for i in ids if i is not None]
            n = sum(counts)
            row = [part, shard, min(known, default=None), max(known, default=None), start, n,
                   build_blob(frames, ids, counts, hashlib.sha256(held.value).digest(), width)]
            frames, ids, counts, size, shard, start = [], [], [], 0, shard + 1, start + n
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.binary()]
            names = ["part", "shard", "first_id", "last_id", "start", "n_tokens", "blob"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for own, texts in rows_of(batches):
            for i, x in zip(own, c.encode_each(texts, BATCH_BYTES)):
                packed = pack_ids(x, width, end_id)
                frames.append(writer.compress(packed))
                ids.append(i)
                counts.append(len(packed) // width)
                size += len(frames[-1])
                if size >= SHARD_BYTES:
                    yield flush()
        if frames:
            yield flush()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    rows = doc_texts(docs).repartitionByRange(order[0], order[1]).sortWithinPartitions(*order)
    rows.mapInArrow(run, _ROW).write.option("compression", "none").parquet(f"{path}/shards")


def _dictionary(spark: SparkSession, path: str) -> bytes:
    row = spark.read.parquet(f"{path}/dictionary").first()
    data = bytes(row["dictionary"])
    if hashlib.sha256(data).hexdigest() != row["sha256"]:
        raise ValueError("the dictionary does not match its hash")
    return data


def _shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_ROW).parquet(f"{path}/shards")


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian uint32 bytes) of every document.

    ``start`` counts the ids of all documents before. One row per part (write task) is
    summed up and broadcast, so its size is bounded by the number of write tasks.
    """
    held = spark.sparkContext.broadcast(_dictionary(spark, path))
    shards = _shards(spark, path)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    base, total = {}, 0
    for row in sorted(parts, key=lambda r: r["part"]):
        base[row["part"]] = total
        total += row["n"]
    before = spark.sparkContext.broadcast(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "start", "blob"))):
                shard = Shard(row[2], held.value)
                starts = before.value[row[0]] + row[1] + np.cumsum(shard.counts) - shard.counts
                ids = [shard.ids(k).tobytes() for k in range(len(shard.counts))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64()), pa.array(starts, pa.int64()),
                     pa.array(shard.counts, pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return shards.select("part", "start", "blob").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a few documents: shards are chosen by id range, frames by offset."""
    held, wanted = spark.sparkContext.broadcast(_dictionary(spark, path)), set(doc_ids)
    inside = F.lit(False)
    for i in sorted(wanted):
        inside = inside | F.lit(i).between(F.col("first_id"), F.col("last_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                shard = Shard(blob, held.value)
                at = [k for k, i in enumerate(shard.doc_ids) if i in wanted]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.doc_ids[k] for k in at], pa.int64()),
                     pa.array([shard.ids(k).tobytes() for k in at], pa.binary())], ["doc_id", "ids"])

    return _shards(spark, path).where(inside).select("blob").mapInArrow(run, "doc_id long, ids binary")


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (unsigned crc32 of the ids' bytes)."""
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
