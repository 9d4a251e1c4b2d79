"""Benchmark decontamination by a broadcast set of normalised test n-grams.

The benchmark's windows are split, by hash, into as many sets as keep each one under
``SET_BYTES``; each set is broadcast alone and the documents pass through the scans one
after another inside the same stage, so a larger benchmark needs more scans, never a
larger broadcast. A scan turns words into the set's word numbers, hashes every run of
known words with numpy and verifies each hit against the window's exact word numbers.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bursa.llm.common import doc_texts, give_back, rows_of, sliced, text_slices, word_blocks

WINDOW = 10
SET_BYTES = 32 << 20
# A-Z become a-z; what is neither a digit, a letter nor beyond ASCII becomes a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_STATE = "doc_id long, text binary, n_words long, starts array<long>, ends array<long>, items array<long>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _hash(ids: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    h = np.zeros(len(starts), np.uint64)
    for k in range(length):
        h = (h ^ (ids[starts + k].astype(np.uint64) + np.uint64(1))) * _PRIME
    return h


class WindowSet:
    """Windows by length: sorted hashes for the scan, exact word numbers to verify."""

    def __init__(self, rows: list[tuple[bytes, int]]):
        self.vocab: dict[bytes, int] = {}
        self.items: dict[bytes, list[int]] = defaultdict(list)
        lengths = defaultdict(set)
        for window, item in rows:
            ids = np.array([self.vocab.setdefault(w, len(self.vocab)) for w in window.split()], np.int32)
            self.items[ids.tobytes()].append(item)
            lengths[len(ids)].add(ids.tobytes())
        self.hashes = {}
        for n, keys in lengths.items():
            ids = np.frombuffer(b"".join(keys), np.int32)
            self.hashes[n] = np.unique(_hash(ids, np.arange(0, len(ids), n), n))

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Word count, merged [start, end) word ranges that are hit, items found."""
        parts = [np.array(list(map(self.vocab.get, block, repeat(-1))), np.int32)
                 for block in word_blocks(text.translate(_TABLE))]
        ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
        known = np.flatnonzero(ids >= 0)
        found, items = [], set()
        if len(known):
            # run: how many known words follow in a row from each known word on
            last = np.append(np.flatnonzero(np.diff(known) != 1), len(known) - 1)
            run = known[last[np.searchsorted(last, np.arange(len(known)))]] - known + 1
            for n, hashes in self.hashes.items():
                starts = known[run >= n]
                if not len(starts):
                    continue
                h = _hash(ids, starts, n)
                at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                for s in starts[hashes[at] == h].tolist():
                    if (key := ids[s:s + n].tobytes()) in self.items:
                        found.append((s, s + n))
                        items.update(self.items[key])
        return len(ids), merged(found), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (window, item_id); an item of fewer words, but not none, is one window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches):
            out, items = [], []
            for item, text in zip(ids, texts):
                words = words_of(text)
                own = {b" ".join(words[i:i + window]) for i in range(max(1, len(words) - window + 1))} - {b""}
                out += own
                items += [item] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(items, pa.int64())],
                                             ["window", "item_id"])

    named = benchmark.select(F.col("item_id").alias("doc_id"), "text")
    return doc_texts(named).where("doc_id IS NOT NULL").mapInArrow(run, "window binary, item_id long").distinct()


def window_sets(benchmark: DataFrame, window: int = WINDOW, set_bytes: int = SET_BYTES) -> Iterator[WindowSet]:
    """The benchmark as sets of at most about ``set_bytes``, one after another."""
    rows = benchmark_windows(benchmark, window)
    size = rows.agg(F.sum(F.length("window") + 200)).first()[0] or 0
    n = -(-size // set_bytes) or 1
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("window"), F.lit(n)) == k)
        yield WindowSet([(bytes(r[0]), r[1]) for r in part.sort("window", "item_id").collect()])


def _scanned(docs: DataFrame, benchmark: DataFrame, window: int, set_bytes: int) -> DataFrame:
    spark = docs.sparkSession
    none = F.array().cast("array<long>")
    df = doc_texts(docs).select("*", F.lit(0).cast("long").alias("n_words"), none.alias("starts"),
                                none.alias("ends"), none.alias("items"))
    for one in window_sets(benchmark, window, set_bytes):
        known = spark.sparkContext.broadcast(one)

        def run(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            scan = known.value.scan
            for batch in sliced(batches):
                counts, starts, ends, items = [], [], [], []
                rest = (batch.column(c).to_pylist() for c in ("text", "starts", "ends", "items"))
                for text, a, b, i in zip(*rest):
                    n, hits, more = scan(text or b"")
                    hits = merged([*zip(a, b), *hits])
                    counts.append(n)
                    starts.append([x[0] for x in hits])
                    ends.append([x[1] for x in hits])
                    items.append(sorted(more.union(i)))
                lists = [pa.array(x, pa.list_(pa.int64())) for x in (starts, ends, items)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text"), pa.array(counts, pa.int64()), *lists],
                    ["doc_id", "text", "n_words", "starts", "ends", "items"])

        df = df.mapInArrow(run, _STATE)
    return df


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  set_bytes: int = SET_BYTES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null or empty text has no words and is clean; an empty benchmark marks nothing;
    items with a null id are left out; repeated rows give repeated result rows.
    """
    hit = F.expr("aggregate(zip_with(ends, starts, (b, a) -> b - a), 0L, (x, y) -> x + y)")
    names = F.concat_ws(",", F.array_sort(F.transform("items", lambda x: x.cast("string"))))
    return _scanned(docs, benchmark, window, set_bytes).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (F.size("starts") > 0).alias("contaminated"))


def _is_clean(known):
    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        scan = known.value.scan
        out = [not scan(t)[1] for part in text_slices(texts) for t in part]
        give_back()
        return pa.array(out, pa.bool_())

    return clean


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                    set_bytes: int = SET_BYTES) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, all columns kept.

    Null and empty texts have no words and stay; an empty benchmark removes nothing."""
    for one in window_sets(benchmark, window, set_bytes):
        known = docs.sparkSession.sparkContext.broadcast(one)
        docs = docs.where(_is_clean(known)(F.col("text").cast("string").cast("binary")))
    return docs


def cut_spans(text: bytes, hits: list[tuple[int, int]]) -> bytes:
    """The text without the hit words (and what stands between words of one range)."""
    is_word = np.frombuffer(text.translate(_TABLE), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], is_word, [False])).view(np.int8)))
    out, at = [], 0
    for a, b in hits:
        out.append(text[at:edge[2 * a]])
        at = edge[2 * b - 1]
    return b"".join([*out, text[at:]])


def without_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  set_bytes: int = SET_BYTES) -> DataFrame:
    """(doc_id, text) of all documents, the spans of benchmark windows cut out.

    A null text stays null, an empty one empty; a text that is one span becomes empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("text", "starts", "ends")))
            cut = [t if t is None or not a else cut_spans(t, [*zip(a, b)]).decode("utf-8") for t, a, b in rows]
            cut = [t.decode("utf-8") if isinstance(t, bytes) else t for t in cut]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(cut, pa.string())],
                                             ["doc_id", "text"])

    return _scanned(docs, benchmark, window, set_bytes).mapInArrow(run, "doc_id long, text string")
