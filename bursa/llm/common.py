"""Helpers shared by the operators: text batches, word blocks, stored frames, components."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bursa.session import checkpoint_dir

# Words are separated by exactly these bytes (what bytes.split() splits on).
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
BLOCK_BYTES = 1 << 20
SLICE_BYTES = 8 << 20
UDF_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_texts(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id`` as long, ``text`` as UTF-8 bytes and ``more``; no other column is read."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").cast("binary").alias("text"), *more)


def id_fold(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id's text, modulo; a null id counts as the empty text (fold 0)."""
    text = F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def spare_name(df: DataFrame, base: str) -> str:
    """A column name that the frame doesn't have yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def sliced(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Non-empty slices of the batches with about ``size`` bytes of text, or one longer text."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(at, to - at)
            at = to


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts (null: empty) of each slice."""
    for batch in sliced(batches):
        yield batch.column("doc_id").to_pylist(), [x or b"" for x in batch.column("text").to_pylist()]


def text_slices(texts: pa.Array, size: int = UDF_BYTES) -> Iterator[list[bytes]]:
    """The texts of a column (null: empty) in lists of about ``size`` bytes, or one longer text."""
    for batch in sliced(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), size):
        yield [x or b"" for x in batch.column("text").to_pylist()]


def give_back() -> None:
    """Return freed memory to the system: Spark keeps a Python worker, and what it holds,
    for the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def word_blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, in blocks of about ``size`` bytes; no word is cut."""
    at, n = 0, len(data)
    while at < n:
        end = n
        if at + size < n:
            gap = _SPACE.search(data, at + size)
            end = gap.start() if gap else n
        if words := data[at:end].split():
            yield words
        at = end


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of a column of texts (null: empty) with A-Z lower-cased, the place
    there of each word of all texts, one after the other, and how many words each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string()).fill_null("")))
    words, ends = lists.flatten(), lists.offsets.to_numpy()
    real = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty word
    before = np.append(0, np.cumsum(real.to_numpy(zero_copy_only=False)))
    coded = words.filter(real).dictionary_encode()
    return coded.dictionary.view(pa.binary()), coded.indices.to_numpy(), np.diff(before[ends - ends[0]])


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Cut lineage by a table in the shared checkpoint folder; survives lost executors.

    A table, not checkpoint(): a checkpointed frame keeps its plan's size estimate, which
    joins multiply, so an iteration's estimates would outgrow any number of digits."""
    path = scratch(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable over the undirected edges (a, b).

    Alternating large-star and small-star steps, each a grouped minimum and an
    equality join; the minima are stored first, so both join sides are plain shuffles
    and a hub's rows can be split. Nodes without an edge to another node don't appear.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, mark = stored(e), None
    while True:
        seen = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == mark or not seen[0]:
            return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = seen
        both = e.select("u", "v").union(e.select("v", "u"))
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large)
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v")))
        e = stored(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
