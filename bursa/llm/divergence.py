"""Audit of how a language's sources differ in their words.

Each task counts terms with Arrow kernels alone: lower-casing, splitting at a pattern,
dictionary encoding and hash grouping, merged over its batches, so that a source holding
most rows ships each of its terms about once a task. It ships them in columnar shards, by
term: a shard is one row whose value is an Arrow table, so what crosses the JVM are few
rows. A shard's parts are merged as they stream in, by the same hash grouping, and only
terms in enough documents are kept and stored.

For the divergences the kept terms of a language are cut into blocks of bounded size,
each of which meets the language's few totals in a cogroup and is laid out as a matrix of
terms by sources, on which everything is integer arithmetic on columns.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bursa.llm.common import SLICE_BYTES, sliced, stored

BREAK = r"[\x00-\x40\x5B-\x60\x7B-\x7F]"
MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
SHARD_TERMS = 1 << 15   # terms of a shard on average
BLOCK_CELLS = 1 << 20   # cells of a matrix block
MERGE_ROWS = 1 << 19    # rows that a task gathers before it merges them
SHARDS = 1024           # into which terms are dealt while they are counted
COUNTS = "lang string, source string, term string, n long, head boolean"
_NAMES = ["lang", "source", "term", "n", "docs"]


def _tokens(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(text's place, term) of every term, A-Z lower-cased."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=BREAK + "+")
    place, term = pc.list_parent_indices(lists), pc.list_flatten(lists)
    full = pc.greater(pc.binary_length(term), 0)
    return place.filter(full), term.filter(full)


def _per_text(texts: pa.Array) -> pa.Table:
    """(place, term, n) of each text's distinct terms."""
    place, term = _tokens(texts)
    code = term.dictionary_encode()
    counts = pa.table({"place": place, "code": code.indices}).group_by(["place", "code"]).aggregate([([], "count_all")])
    return pa.table({"place": counts["place"], "term": pa.chunked_array([code.dictionary]).take(counts["code"]),
                     "n": counts["count_all"]})


def _pieces(text: bytes) -> Iterator[pa.Array]:
    """A long text in pieces of about a slice, cut where no term is."""
    gap, at = re.compile(BREAK.encode()), 0
    while at < len(text):
        found = gap.search(text, at + SLICE_BYTES)
        end = found.start() if found else len(text)
        yield pa.array([text[at:end].decode()])
        at = end


def _batch_counts(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of a slice of rows."""
    texts = batch.column("text")
    if batch.num_rows == 1 and pc.binary_length(texts)[0].as_py() and pc.binary_length(texts)[0].as_py() > SLICE_BYTES:
        parts = pa.concat_tables(_per_text(piece) for piece in _pieces(texts[0].as_py()))
        counts = parts.group_by(["place", "term"]).aggregate([("n", "sum")]).rename_columns(["place", "term", "n"])
    else:
        counts = _per_text(texts.cast(pa.string()))
    rows = pa.table({"lang": batch.column("lang").take(counts["place"].combine_chunks()),
                     "source": batch.column("source").take(counts["place"].combine_chunks()),
                     "term": counts["term"], "n": counts["n"]})
    out = rows.group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("n", "count")])
    return out.rename_columns(["lang", "source", "term", "n", "docs"])


class _Merger:
    """Count tables merged as they come, ``rows`` of them at a time."""

    def __init__(self):
        self.parts, self.rows, self.merged = [], 0, 0

    def add(self, part: pa.Table) -> None:
        self.parts.append(part)
        self.rows += part.num_rows
        if self.rows > max(MERGE_ROWS, 2 * self.merged):
            self.table()

    def table(self) -> pa.Table | None:
        if len(self.parts) > 1:
            grouped = pa.concat_tables(self.parts).group_by(["lang", "source", "term"])
            self.parts = [grouped.aggregate([("n", "sum"), ("docs", "sum")]).rename_columns(_NAMES)]
            self.rows = self.merged = self.parts[0].num_rows
        return self.parts[0] if self.parts else None


def _shards(counts: pa.Table, n: int) -> Iterator[tuple[int, bytes]]:
    """(shard, Arrow stream) for each shard that has terms; a term is in one shard."""
    terms = counts["term"].combine_chunks().dictionary_encode()
    of_term = np.array([zlib.crc32(t.encode()) % n for t in terms.dictionary.to_pylist()], np.int64)
    shard = of_term[terms.indices.to_numpy()] if len(of_term) else np.zeros(0, np.int64)
    order = np.argsort(shard, kind="stable")
    counts, shard = counts.take(pa.array(order)).combine_chunks(), shard[order]
    starts = np.flatnonzero(np.diff(shard, prepend=-1))
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(shard)]):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, counts.schema) as out:
            out.write_table(counts.slice(lo, hi - lo))
        yield int(shard[lo]), sink.getvalue().to_pybytes()


def partial_counts(docs: DataFrame, n_shards: int) -> DataFrame:
    """(shard, part): each task's counts lang, source, term, n (occurrences), docs (rows
    that have it), as Arrow streams. Null lang, source and text count as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shipped(table: pa.Table) -> Iterator[pa.RecordBatch]:
            shards, parts, size = [], [], 0
            for shard, part in _shards(table, n_shards):
                shards.append(shard)
                parts.append(part)
                size += len(part)
                if size > SLICE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(parts)], ["shard", "part"])
                    shards, parts, size = [], [], 0
            if shards:
                yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(parts)], ["shard", "part"])

        held = _Merger()
        for batch in sliced(batches):
            held.add(_batch_counts(batch))
            if held.merged > MERGE_ROWS:  # too many different ones to hold: ship them and begin anew
                yield from shipped(held.table())
                held = _Merger()
        if held.parts:
            yield from shipped(held.table())

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    return docs.select(*names, text).mapInArrow(run, "shard int, part binary")


def _kept(counts: pa.Table, min_docs: int) -> pa.Table:
    """The counts of terms in at least ``min_docs`` rows of their language; ``head`` marks
    one row of each term."""
    by = counts.group_by(["lang", "term"]).aggregate([("docs", "sum"), ("source", "min")])
    by = by.filter(pc.greater_equal(by["docs_sum"], min_docs))
    out = counts.join(by, ["lang", "term"], join_type="inner")
    return pa.table({"lang": out["lang"], "source": out["source"], "term": out["term"], "n": out["n"],
                     "head": pc.equal(out["source"], out["source_min"])})


def kept_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """lang, source, term, n, head over the terms in at least ``min_docs`` rows of a language."""
    parts = partial_counts(docs, SHARDS).repartition("shard").sortWithinPartitions("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = _Merger(), None
        for batch in batches:
            for shard, part in zip(batch.column("shard").to_pylist(), batch.column("part")):
                if shard != at and held.parts:
                    yield from _kept(held.table(), min_docs).to_batches()
                    held = _Merger()
                at = shard
                held.add(pa.ipc.open_stream(part.as_buffer()).read_all())
        if held.parts:
            yield from _kept(held.table(), min_docs).to_batches()

    return parts.mapInArrow(run, COUNTS)


def scaled(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 * count / total), exact in 64 bits while total is below 9 * 10^15."""
    whole, rest = np.divmod(count, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return whole + 1


def gain(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def _shard(counts: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """Partial sums of each pair of sources, and each source's best terms of this shard."""
    order = sorted(range(groups.num_rows), key=lambda i: groups["source"][i].as_py())
    groups = groups.take(order)
    sources, n_sources = groups["source"].combine_chunks(), groups.num_rows
    total = (groups["total"].to_numpy() + groups["vocab"].to_numpy()).astype(np.int64)
    lang, whole = groups["lang"][0].as_py(), int(groups["lang_total"][0].as_py() + groups["vocab"][0].as_py())
    code = counts["term"].combine_chunks().dictionary_encode()
    terms, rows = code.dictionary, code.indices.to_numpy()
    cols = pc.index_in(counts["source"].combine_chunks(), sources).to_numpy(zero_copy_only=False).astype(np.int64)
    n = counts["n"].to_numpy()
    pairs = np.zeros((n_sources, n_sources), np.int64)
    best: list[list[tuple[int, str]]] = [[] for _ in range(n_sources)]
    by_term = np.argsort(rows, kind="stable")
    step = max(1, BLOCK_CELLS // n_sources)
    for lo in range(0, len(terms), step):
        hi = min(lo + step, len(terms))
        own = by_term[np.searchsorted(rows, lo, sorter=by_term):np.searchsorted(rows, hi, sorter=by_term)]
        c = np.zeros((n_sources, hi - lo), np.int64)
        c[cols[own], rows[own] - lo] = n[own]
        p = scaled(c + 1, total[:, None])
        q = scaled(c.sum(0) + 1, np.int64(whole))
        for a in range(n_sources):
            pairs[a] += gain(p[a], p).sum(1)
            ahead = np.flatnonzero((c[a] > 0) & (p[a] > q))
            f = gain(p[a, ahead], q[ahead])
            if len(f) > top:  # ties of the last one stay for the order by term
                keep = f >= np.partition(f, len(f) - top)[len(f) - top]
                ahead, f = ahead[keep], f[keep]
            best[a] += zip(f.tolist(), terms.take(pa.array(ahead + lo)).to_pylist())
            best[a] = sorted(best[a], key=lambda x: (-x[0], x[1]))[:top]
    names = sources.to_pylist()
    out = [(names[a], "pair", names[b], int(pairs[a, b])) for a in range(n_sources) for b in range(n_sources) if a != b]
    out += [(names[a], "term", term, f) for a in range(n_sources) for f, term in best[a]]
    source, part, item, value = zip(*out) if out else ((), (), (), ())
    return pa.table([pa.array([lang] * len(out), pa.string()), pa.array(source, pa.string()), pa.array(part, pa.string()),
                     pa.array(item, pa.string()), pa.array(value, pa.int64())],
                    names=["lang", "source", "part", "item", "value"])


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS,
                shard_terms: int = SHARD_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank (from 1 per lang, source and part, by value
    descending, then item).

    ``pair``: each other source of the language and the summed divergence over the
    language's kept terms (those in at least ``min_docs`` rows), 0 if it keeps none.
    ``term``: the source's terms whose share exceeds the language's, at most ``top``.

    Null lang, source and text count as empty; rows without terms still make their
    source occur; repeated rows count each; a language of one source has no pairs; an
    empty table gives no row. Only lang, source and text are read.
    """
    counts = stored(kept_counts(docs, min_docs))
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if("head").alias("heads"))
    by_lang = Window.partitionBy("lang")
    groups = stored(groups.join(totals, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total"),
        F.sum(F.coalesce("total", F.lit(0))).over(by_lang).cast("long").alias("lang_total"),
        F.sum(F.coalesce("heads", F.lit(0))).over(by_lang).cast("long").alias("vocab")))
    shards = F.greatest(F.lit(1), F.ceil(F.col("vocab") / shard_terms)).cast("int")
    per_lang = groups.groupBy("lang").agg(F.max(shards).alias("shards"))
    left = counts.join(per_lang, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), "shards").cast("int").alias("shard"), "source", "term", "n")
    right = groups.select("*", F.explode(F.sequence(F.lit(0), shards - 1)).alias("shard"))

    def run(counts: pa.Table, groups: pa.Table) -> pa.Table:
        return _shard(counts, groups, top)

    found = stored(left.groupBy("lang", "shard").cogroup(right.groupBy("lang", "shard")).applyInArrow(
        run, "lang string, source string, part string, item string, value long"))
    place = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    keys = ["lang", "source", "part", "item"]
    pairs = found.where("part = 'pair'").groupBy(*keys).agg(F.sum("value").alias("value"))
    terms = found.where("part = 'term'")
    ranked = F.row_number().over(place).alias("rank")
    return pairs.select(*keys, "value", ranked).unionByName(terms.select(*keys, "value", ranked).where(F.col("rank") <= top))
