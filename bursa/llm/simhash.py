"""SimHash near-dedup with one-wildcard segment variants.

Two 64-bit fingerprints at most two bits apart agree, up to one bit, in one of their
two 32-bit halves. Each distinct fingerprint is therefore indexed under its halves and
under every half with one bit left out; an equality join on these keys gives the
candidates and the bit count of the XOR verifies them.

A key's bucket of two is read off its minimum and maximum, up to ``BUCKET`` members are
joined with each other. Larger buckets (many near copies of one text) go another exact
way: their members list all values within one bit of themselves. Two fingerprints share
such a value exactly if they are at most two bits apart, so no pair is lost, and a value
has at most 65 members, each linked to the smallest one only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bursa.llm.common import components, doc_texts, give_back, sliced, spare_name, stored, word_blocks

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BUCKET = 64
SPREAD = 10_000  # fingerprints that one task expands
SENT_KEYS = 500_000  # of 16 bytes each


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set: eight bits a time, one in each byte."""
    h = np.append(h, np.zeros(-len(h) % 255, "<u8"))  # a byte holds sums of 255 rows
    out = np.empty((8, 8), np.int64)
    for b in range(8):
        sums = ((h >> np.uint64(b)) & np.uint64(0x0101010101010101)).reshape(-1, 255).sum(1, dtype="<u8")
        out[:, b] = sums.view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)
    return out.ravel()


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Bit i is 1 if it is set in over half of the shingles' hashes; no word: 0."""
    ones, n, carry = np.zeros(64, np.int64), 0, []
    for block in word_blocks(text.lower()):
        carry += block
        if len(carry) >= words:
            shingles = map(b" ".join, zip(*(carry[i:] for i in range(words))))
            h = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8")
            ones += bit_counts(h)
            n += len(h)
            carry = carry[len(carry) - words + 1:]
    if not n:
        return xxhash.xxh64_intdigest(b" ".join(carry), SEED) if carry else 0
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, row: str | None = None) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long; one row per input row.

    With ``row``, the name of a column of row numbers, also ``row`` and the text's hash."""
    more = [F.col(row).alias("row"), F.xxhash64(F.col("text").cast("string")).alias("hash")] if row else []
    names = ["doc_id", *(["row", "hash"] if row else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            fps = np.array([fingerprint(t or b"", words) for t in batch.column("text").to_pylist()], dtype="<u8")
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(fps.view("<i8"))], [*names, "fp"])
        give_back()

    return doc_texts(docs, *more).mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "fp"]))


def links(classes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all distinct ``fp`` at most two bits apart."""
    # 66 keys come from each fingerprint: spread them, so that no task makes many more than others.
    classes = stored(classes.select("fp").repartition(max(1, classes.count() // SPREAD)))
    # Key: 1 bit for the half, 6 for the wildcard (32: none), 32 for the rest of the half.
    variants = classes.select("fp", F.explode(F.expr(
        "flatten(transform(array(0L, 1L), s -> transform(sequence(0L, 32L), i -> "
        "  shiftleft(s * 64 + i, 32) | ((shiftrightunsigned(fp, cast(s * 32 AS int)) & 4294967295L)"
        "                               & ~ if(i = 32, 0L, shiftleft(1L, cast(i AS int)))))))")).alias("key"))
    near = "bit_count(a ^ b) <= 2"
    keys = stored(variants.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                  .where("n > 1"))
    pairs = keys.where("n = 2").where(near).select("a", "b")
    # Few such keys are sent to where the variants are made; many are met by a shuffle.
    large = keys.where("n > 2").select("key", "n")
    large = F.broadcast(large) if large.count() <= SENT_KEYS else large
    members = stored(variants.join(large, "key"))
    few = members.where(F.col("n") <= BUCKET)
    joined = few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")), "key") \
        .where("a < b").where(near).select("a", "b")
    balls = members.where(F.col("n") > BUCKET).select("fp").distinct().select("fp", F.explode(F.expr(
        "transform(sequence(0, 64), i -> if(i = 64, fp, fp ^ shiftleft(1L, i)))")).alias("z"))
    balls = stored(balls)
    low = stored(balls.groupBy("z").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1"))
    starred = balls.join(low.select("z", "a"), "z").where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(joined).unionByName(starred)


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id whose fingerprint is reachable over links of at
    most two bits. Rows without words (null, empty) have fingerprint 0 and link like any
    other. Rows with a null id take part; a component of such rows only has a null id.
    Repeated rows give repeated result rows. An empty table gives no row.
    """
    fps = stored(fingerprints(docs, words))
    named, low = _named(fps, F.col("doc_id"))
    named = stored(named.join(low, "c").select("fp", F.col("first").alias("component_id")))
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _named(fps: DataFrame, place: Column) -> tuple[DataFrame, DataFrame]:
    """(fp, c): the component of each fingerprint; (c, first): a component's smallest ``place``."""
    classes = stored(fps.groupBy("fp").agg(F.min(place).alias("first")))
    comp = components(links(classes))
    named = stored(classes.join(comp, classes.fp == comp.node, "left")
                   .select("fp", "first", F.coalesce("component", "fp").alias("c")))
    return named.select("fp", "c"), stored(named.groupBy("c").agg(F.min("first").alias("first")))


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """Exactly one row of ``docs`` per component, all columns kept.

    It is the row with the smallest doc_id (null ids last, then by the text's hash). Rows
    are told apart by a stored row number, so different texts under one id or without an
    id stay if they are in different components.
    """
    row = spare_name(docs, "row")
    docs = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    fps = stored(fingerprints(docs, words, row))
    _, low = _named(fps, F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash", "row"))
    keep = spare_name(docs, "keep_row")
    return docs.join(low.select(F.col("first.row").alias(keep)), F.col(row) == F.col(keep), "left_semi").drop(row)
