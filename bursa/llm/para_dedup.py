"""Repeated passages: paragraph MinHash banding, exact check, components; repeated word windows.

Passages that repeat word for word are found whatever their line layout: every window of
PASSAGE_WORDS words that occurs twice or more. Windows are first narrowed down by the
smallest hash of their GRAM_WORDS-word grams, which equal windows share: only windows whose
smallest gram occurs twice are compared, by a 128-bit hash. Consecutive repeated windows of
a text make one passage. Near copies are found line by line:

A paragraph is a line of at least MIN_WORDS words (a longer line counts whole); words
are lower-cased for A-Z. Equal paragraphs form a class by a 128-bit digest. Classes are
MinHashed over five-word shingles and cut into BANDS bands of ROWS values, tuned for
recall: at a similarity of 0.8 a pair is missed with probability (1 - 0.8^4)^16 = 2e-4.
Classes that collide in a band are joined, their exact Jaccard similarity is computed
from the texts, and components of the verified links become the groups of which one
paragraph stays.

A band value with up to BUCKET classes is joined all with all. A larger one is resolved
by pivots: each round every member is checked against one member of its bucket, links are
merged into components, and only members outside their bucket's largest component
stay open. Members of one component need no more checks with each other. What is still
open after the rounds is compared with the whole bucket, so no link between components
is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bursa.llm.common import components, doc_texts, sliced, stored

MIN_WORDS = 40
PASSAGE_WORDS, GRAM_WORDS = 50, 25
SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
BUCKET = 64
PIVOT_ROUNDS = 4
SEED = 5
_rng = np.random.default_rng(SEED)
_A = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def paragraphs(text: bytes, min_words: int = MIN_WORDS) -> Iterator[tuple[int, int, int, bytes]]:
    """(number of the line, first byte, end byte, normalised words) of each long enough line."""
    at = 0
    for k, line in enumerate(text.split(b"\n")):
        # a line of n words has at least 2n - 1 bytes
        if len(line) >= 2 * min_words - 1 and len(words := line.lower().split()) >= min_words:
            yield k, at, at + len(line), b" ".join(words)
        at += len(line) + 1


def shingles(words: bytes, size: int = SHINGLE_WORDS) -> set[bytes]:
    w = words.split(b" ")
    return {b" ".join(x) for x in zip(*(w[i:] for i in range(size)))} or {words}


def bands(words: bytes, size: int = SHINGLE_WORDS) -> list[int]:
    """BANDS signed 64-bit keys; a key holds its band's number."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles(words, size)), np.uint64)
    low = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(h), 4096):
        x = h[k:k + 4096, None] * _A + _B
        x ^= x >> np.uint64(31)
        low = np.minimum(low, x.min(0))
    rows = low.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(r.tobytes(), k) - (1 << 63) for k, r in enumerate(rows)]


def paragraph_rows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """rid, doc_id, paragraph, start, end (bytes), n_words, h1, h2 (digest), bands, words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for r, i, t in zip(*(batch.column(c).to_pylist() for c in ("rid", "doc_id", "text"))):
                for k, a, b, w in paragraphs(t or b"", min_words):
                    h1, h2 = np.frombuffer(hashlib.md5(w).digest(), "<i8").tolist()
                    out.append((r, i, k, a, b, w.count(b" ") + 1, h1, h2, bands(w), w))
                    if len(out) == 4096:
                        yield _batch(out)
                        out = []
            if out:
                yield _batch(out)

    return docs.select("rid", "doc_id", "text").mapInArrow(
        run, "rid long, doc_id long, paragraph int, start long, end long, n_words long, "
             "h1 long, h2 long, bands array<long>, words binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.list_(pa.int64()), pa.binary())
    names = ["rid", "doc_id", "paragraph", "start", "end", "n_words", "h1", "h2", "bands", "words"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def word_hashes(text: bytes) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, text.lower().split()), np.uint64)


def window_hashes(h: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash of each ``size`` successive entries, put together from windows of powers of two."""
    def joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(29))) * _A[seed] + _B[seed]
        return (x ^ (x >> np.uint64(32))) * _A[seed + 1] + y

    n = len(h) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out, at, step = None, 0, 1
    while True:
        if size & step:
            out = h[:n] if out is None else joined(out, h[at:at + n])
            at += step
        if 2 * step > size:
            return out ^ (out >> np.uint64(31))
        h = joined(h[:-step], h[step:])
        step *= 2


def smallest_grams(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All gram hashes, and for each window of ``size`` words the smallest one inside it."""
    g = window_hashes(h, GRAM_WORDS, 0)
    width, low, step = size - GRAM_WORDS + 1, g, 1
    while 2 * step <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    n = len(g) - width + 1
    return g, np.minimum(low[:n], low[width - step:width - step + n])


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of each word (as bytes.split() cuts them)."""
    c = np.frombuffer(text, np.uint8)
    inside = np.concatenate(([0], ((c != 32) & ((c < 9) | (c > 13))).astype(np.int8), [0]))
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def passages(docs: DataFrame, size: int = PASSAGE_WORDS) -> DataFrame:
    """Runs of words whose windows of ``size`` words all occur elsewhere, too, in the stored
    rows (rid, doc_id, text): rid, doc_id, paragraph, start, end, n_words, group_doc_id,
    group_paragraph, n_group, removed.

    A window's first place (smallest doc_id, null ids last, then word) stays. A run holds only
    first places or only others; its group is where its first window first occurs, n_group is
    how often its most frequent window occurs."""
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            values, times, rids = [], [], []
            for r, t in zip(batch.column("rid").to_pylist(), batch.column("text").to_pylist()):
                h = word_hashes(t or b"")
                if len(h) >= size:
                    g, low = smallest_grams(h, size)
                    all_, n = np.unique(g, return_counts=True)
                    own = np.unique(low)
                    values.append(own)
                    times.append(n[np.searchsorted(all_, own)])
                    rids.append(np.full(len(own), r))
            if values:
                yield grouped(["value"], [np.concatenate(values).view("<i8")], np.concatenate(times),
                              {"rids": np.concatenate(rids)})

    def grouped(names: list[str], keys: list[np.ndarray], times: np.ndarray, lists: dict) -> pa.RecordBatch:
        """One row per key of the batch: how often it occurs, and lists of where."""
        order = np.lexsort(keys)
        keys = [k[order] for k in keys]
        new = np.flatnonzero(np.any([np.diff(k, prepend=k[0] + 1) != 0 for k in keys], axis=0))
        ends = pa.array(np.append(new, len(order)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [*(pa.array(k[new]) for k in keys), pa.array(np.add.reduceat(times[order], new)),
             *(pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in lists.values())], [*names, "n", *lists])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            keys, rids, pos = [], [], []
            for r, t, hot in zip(*(batch.column(c).to_pylist() for c in ("rid", "text", "hot"))):
                h = word_hashes(t)
                at = np.flatnonzero(np.isin(smallest_grams(h, size)[1], np.array(hot, "<i8").view("<u8")))
                keys.append([window_hashes(h, size, k)[at].view("<i8") for k in (2, 4)])
                rids.append(np.full(len(at), r))
                pos.append(at)
            if sum(map(len, pos)):
                yield grouped(["w1", "w2"], [np.concatenate(k) for k in zip(*keys)], np.ones(sum(map(len, pos)), np.int64),
                              {"rids": np.concatenate(rids), "pos": np.concatenate(pos)})

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for t, r, i, runs in zip(*(batch.column(c).to_pylist() for c in ("text", "rid", "doc_id", "runs"))):
                a, b = word_places(t)
                lines = np.flatnonzero(np.frombuffer(t, np.uint8) == 10)
                for x in runs:
                    first, last = int(a[x["pos"]]), int(b[x["last"] + size - 1])
                    out.append((r, i, x["pos"], int(np.searchsorted(lines, first)), first, last,
                                x["last"] - x["pos"] + size, x["f_rid"], x["f_pos"], x["n"], x["removed"]))
            if out:
                kinds = (*[pa.int64()] * 3, pa.int32(), *[pa.int64()] * 6, pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], _PLACED)

    def lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for t, r, i, at in zip(*(batch.column(c).to_pylist() for c in ("text", "rid", "doc_id", "at"))):
                line = np.searchsorted(np.flatnonzero(np.frombuffer(t, np.uint8) == 10), word_places(t)[0][at])
                out += [(r, p, i, k) for p, k in zip(at, line.tolist())]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 ["f_rid", "f_pos", "group_doc_id", "group_paragraph"])

    found = stored(docs.select("rid", "text").mapInArrow(grams, "value long, n long, rids array<long>"))
    often = stored(found.groupBy("value").agg(F.sum("n").alias("n")).where("n > 1").select("value"))
    hot = found.select("value", "rids").join(often, "value").select("value", F.explode("rids").alias("rid")) \
        .groupBy("rid").agg(F.collect_list("value").alias("hot"))
    near = stored(docs.select("rid", "text").join(hot, "rid").mapInArrow(
        windows, "w1 long, w2 long, n long, rids array<long>, pos array<long>"))
    ids = docs.select("rid", "doc_id")
    each = near.select("w1", "w2", F.explode(F.arrays_zip("rids", "pos")).alias("p")) \
        .select("w1", "w2", F.col("p.rids").alias("rid"), F.col("p.pos").alias("pos"))
    first = each.join(ids, "rid").groupBy("w1", "w2").agg(F.count("*").alias("n"), F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "pos", "rid")).alias("f")).where("n > 1")
    first = stored(first.select("w1", "w2", "n", F.col("f.rid").alias("f_rid"), F.col("f.pos").alias("f_pos")))
    known = near.drop("n").join(first, ["w1", "w2"]).select(
        F.explode(F.arrays_zip("rids", "pos")).alias("p"), "n", "f_rid", "f_pos").select(
        F.col("p.rids").alias("rid"), F.col("p.pos").alias("pos"), "n", "f_rid", "f_pos")
    known = known.withColumn("removed", (F.col("rid") != F.col("f_rid")) | (F.col("pos") != F.col("f_pos")))
    order = Window.partitionBy("rid", "removed").orderBy("pos")
    runs = known.withColumn("run", F.col("pos") - F.row_number().over(order)).groupBy("rid", "removed", "run").agg(
        F.min(F.struct("pos", "f_rid", "f_pos")).alias("a"), F.max("pos").alias("last"), F.max("n").alias("n")) \
        .select("rid", F.struct("a.pos", "last", "n", "a.f_rid", "a.f_pos", "removed").alias("x"))
    by_row = stored(runs.groupBy("rid").agg(F.collect_list("x").alias("runs")))
    rows = stored(docs.join(by_row, "rid").mapInArrow(
        placed, ", ".join(f"{c} {'int' if c == 'paragraph' else 'boolean' if c == 'removed' else 'long'}" for c in _PLACED)))
    sources = docs.join(rows.groupBy(F.col("f_rid").alias("rid")).agg(F.collect_set("f_pos").alias("at")), "rid") \
        .mapInArrow(lines_of, "f_rid long, f_pos long, group_doc_id long, group_paragraph int")
    return rows.join(stored(sources), ["f_rid", "f_pos"]).drop("f_rid", "f_pos", "pos")


_PLACED = ["rid", "doc_id", "pos", "paragraph", "start", "end", "n_words", "f_rid", "f_pos", "n_group", "removed"]


def similar(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose five-word shingle sets have at least this Jaccard similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = shingles(x), shingles(y)
                both = len(x & y)
                good.append(both >= similarity * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(good, pa.bool_())),
                                              batch.column("b").filter(pa.array(good, pa.bool_()))], ["a", "b"])

    x, y = (texts.select(F.col("cid").alias(k), F.col("words").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    return stored(pairs.distinct()).join(x, "a").join(y, "b").select("a", "b", "x", "y") \
        .mapInArrow(run, "a long, b long")


def _resolved(hot: DataFrame, texts: DataFrame, edges: DataFrame, similarity: float) -> DataFrame:
    """Edges plus what connects the members (band, cid, copies) of large buckets."""
    for r in range(PIVOT_ROUNDS + 1):
        label = stored(components(edges))
        held = stored(hot.join(label, hot.cid == label.node, "left")
                      .select("band", "cid", "copies", F.coalesce("component", "cid").alias("c")))
        sizes = held.groupBy("band", "c").agg(F.count("*").alias("n"), F.max_by(
            "cid", F.struct("copies", F.xxhash64("cid", F.lit(r)))).alias("pivot"), F.max("copies").alias("copies"))
        # Round 0: the most copied class, likely the original; then members of the largest component.
        order = F.struct("copies", "n", "c") if r == 0 else F.struct("n", "copies", "c")
        main = stored(sizes.groupBy("band").agg(F.max_by(F.struct("c", "pivot"), order).alias("m"))
                      .select("band", F.col("m.c").alias("mc"), F.col("m.pivot").alias("pivot")))
        open_ = stored(held.join(main, "band").where("c <> mc"))
        if open_.isEmpty():
            break
        if r < PIVOT_ROUNDS:
            pairs = open_.select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b"))
        else:
            other = held.select("band", F.col("cid").alias("o"), F.col("c").alias("oc"))
            pairs = open_.join(other, "band").where("c <> oc") \
                .select(F.least("cid", "o").alias("a"), F.greatest("cid", "o").alias("b"))
        edges = stored(edges.unionByName(similar(pairs, texts, similarity)))
    return edges


def repeated(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row per paragraph that has a copy or near copy: doc_id, paragraph (line number),
    start, end (bytes), n_words, group_doc_id, group_paragraph, n_group, removed.

    A group is a component of equal or linked paragraphs and named by its first place
    (smallest doc_id, then line), the one that stays. Null and empty texts have no
    paragraph. Rows that repeat a doc_id are places of their own; the place that stays is
    the first by doc_id, line, start and row. Rows with a null id come last in that order.
    """
    return _lines(_numbered(docs), min_words, similarity).drop("rid")


def repeated_anywhere(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY,
                      size: int = PASSAGE_WORDS) -> DataFrame:
    """The rows of repeated(), and one per passage that repeats word for word (see passages()),
    whatever lines it spans; its paragraph is the line of its first word.

    A passage inside one paragraph with a row has none of its own, unless the passage is
    removed and the paragraph is not.
    """
    docs = _numbered(docs)
    lines = stored(_lines(docs, min_words, similarity))
    own = lines.select("rid", "paragraph", F.col("end").alias("line_end"), F.col("removed").alias("line_removed"))
    more = passages(docs, size).join(own, ["rid", "paragraph"], "left").where(
        "line_end IS NULL OR end > line_end OR (removed AND NOT line_removed)")
    return lines.drop("rid").unionByName(more.drop("rid", "line_end", "line_removed"))


def _numbered(docs: DataFrame) -> DataFrame:
    return stored(doc_texts(docs).withColumn("rid", F.monotonically_increasing_id()))


def _lines(docs: DataFrame, min_words: int, similarity: float) -> DataFrame:
    """The rows of repeated() and ``rid``, from stored rows (rid, doc_id, text)."""
    rows = stored(paragraph_rows(docs, min_words))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "paragraph", "start", "rid")
    classes = stored(rows.groupBy("h1", "h2").agg(
        F.count("*").alias("copies"), F.first("bands").alias("bands"), F.min(place).alias("place"))
        .withColumn("cid", F.monotonically_increasing_id()))
    keyed = classes.select("cid", "copies", F.explode("bands").alias("band"))
    keys = stored(keyed.groupBy("band").agg(F.count("*").alias("n"), F.min("cid").alias("a"), F.max("cid").alias("b"))
                  .where("n > 1"))
    members = stored(keyed.join(keys.where("n > 2").select("band", "n"), "band"))
    twos = keys.where("n = 2").select("a", "b")
    needed = stored(twos.select(F.col("a").alias("cid")).union(twos.select("b")).union(members.select("cid")).distinct())
    digests = stored(classes.join(needed, "cid").select("cid", "h1", "h2"))
    texts = stored(rows.select("h1", "h2", "words").join(digests, ["h1", "h2"]).select("cid", "words")
                   .dropDuplicates(["cid"]))
    few = members.where(F.col("n") <= BUCKET).select("band", "cid")
    pairs = few.select("band", F.col("cid").alias("a")).join(few.select("band", F.col("cid").alias("b")), "band") \
        .where("a < b").select("a", "b").unionByName(twos)
    edges = stored(similar(pairs, texts, similarity))
    hot = members.where(F.col("n") > BUCKET).select("band", "cid", "copies")
    if not hot.isEmpty():
        edges = _resolved(hot, texts, edges, similarity)
    label = components(edges)
    named = stored(classes.join(label, classes.cid == label.node, "left")
                   .select("h1", "h2", "copies", "place", F.coalesce("component", "cid").alias("c")))
    groups = stored(named.groupBy("c").agg(F.sum("copies").alias("n_group"), F.min("place").alias("kept"))
                    .where("n_group > 1"))
    named = stored(named.select("h1", "h2", "c").join(groups, "c").drop("c"))
    out = rows.drop("bands", "words").join(named, ["h1", "h2"])
    return out.select("rid", "doc_id", "paragraph", "start", "end", "n_words",
                      F.col("kept.doc_id").alias("group_doc_id"), F.col("kept.paragraph").alias("group_paragraph"),
                      "n_group", (~place.eqNullSafe(F.col("kept"))).alias("removed"))


def _cut(text: bytes, rows: list) -> bytes:
    """The text without removed rows, except for what rows that stay hold; emptied lines go."""
    gone = np.zeros(len(text), bool)
    for want in (True, False):
        for r in rows:
            if r["removed"] == want:
                gone[r["start"]:r["end"]] = want
    out, at = [], 0
    for line in text.split(b"\n"):
        stays = ~gone[at:at + len(line)]
        if stays.any() or not line:
            out.append(line if stays.all() else np.frombuffer(line, np.uint8)[stays].tobytes())
        at += len(line) + 1
    return b"\n".join(out)


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text): the documents with removed paragraphs and passages cut out, others unchanged.

    Rows are matched by doc_id, so ids must be unique and not null here."""
    found = repeated_anywhere(docs, min_words, similarity).groupBy("doc_id") \
        .agg(F.collect_list(F.struct("start", "end", "removed")).alias("rows"), F.max("removed").alias("any")).where("any")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [t if t is None or not r else _cut(t, r)
                     for t, r in zip(batch.column("text").to_pylist(), batch.column("rows").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "text"])

    return doc_texts(docs).join(found.drop("any"), "doc_id", "left").mapInArrow(run, "doc_id long, text binary") \
        .select("doc_id", F.col("text").cast("string").alias("text"))
