"""Language-model scores of whole documents.

Words seen MIN_COUNT times that make up at least 1/HOT_SHARE of the training tokens (so at most HOT_SHARE
words) and the end form the model's table, which is broadcast; one more entry stands for
all rarer words. All training texts are cut into windows of table numbers, in which each
word and the end is a target once.

1. The most frequent words' co-occurrence in windows gives kinds of text; two passes of
   expectation-maximisation over all windows give each kind's shares of the table.
2. The attention model learns from all windows which kind the words before call for. It
   trains in rounds: each trainer takes gradient steps over its part of the windows from
   the same start, and Spark averages the changes row by row.
3. Texts are scored in overlapping windows. A rare word costs the rare entry's chance
   there, and its own among rare words: its count's share, mixed with its spelling, a chain
   of subword ids with frequencies taken from all rare training words. Counts are matched
   by a shuffle join, gathered by word within each batch first, and words are spelled behind
   that join, where equal ones meet. The most frequent pairs of ids are broadcast; the
   frequencies of all others are matched by a join, too.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bursa.llm.attention import WINDOW, Model, Trainer, summed
from bursa.llm.bpe import LONG, MEMO, Codec, Shared
from bursa.llm.common import doc_texts, give_back, id_fold, scratch, sliced, split_words, stored
from bursa.llm.token_store import VOCABULARY, shared_codec

FOLDS, HELD_FOLD = 7, 2
ROUNDS = 2  # each takes its share of the windows, all of which are trained on once
WINDOWS_A_TRAINER = 20_000
BATCH_WINDOWS = 256
RATE = 0.1
HOT_SHARE = 500_000
MIN_COUNT = 5  # words seen less often are rare at any size
KINDS, SEED_WORDS = 8, 256
BLEND = 0.02  # of the whole corpus's shares in those of a kind
PAIRS = 1 << 20  # at most so many pairs of subword ids are broadcast; the rest are joined
BACKOFF = 3.0  # weight of an id's own frequency beside that of the pair
FLUSH_WORDS = 400_000
FLUSH_WINDOWS = 50_000
PART_WORDS = 4096  # table entries in one row of partial sums
SCORE_TOKENS = 1 << 17
END = b"\n"  # stands for the end in word counts; no word holds it
OPEN = pa.list_(pa.struct([("key", pa.int64()), ("weight", pa.float64())]))
SPELLED = pa.struct([("spelled", pa.float64()), ("open", OPEN)])


class Words:
    """Subword ids of words, each encoded after a space, with a bounded memo."""

    def __init__(self, codec: Codec):
        self.codec, self.memo = codec, {}
        self.end = len(codec.table) - 1

    def _new(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of the words that the memo lacks."""
        get = self.memo.get
        new = [*{w for w in words if get(w) is None}]
        found = dict(zip(new, self.codec._merged([" " + w.decode() for w in new]))) if new else {}
        for w, ids in found.items():
            if len(w) <= LONG and len(self.memo) < MEMO:
                self.memo[w] = ids
        return found

    def many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids one after the other, and how many each has."""
        get, new = self.memo.get, self._new(words)
        each = [get(w) or new[w] for w in words] if new else [*map(self.memo.__getitem__, words)]
        return np.frombuffer(b"".join(each), "<u4").astype(np.int64), np.array([*map(len, each)], np.int64) // 4


_WORDS: dict[int, Words] = {}


def words_of(shared: Shared) -> Words:
    if shared.key not in _WORDS:
        _WORDS.clear()
        _WORDS[shared.key] = Words(shared.get())
    return _WORDS[shared.key]


def _windows(words: np.ndarray) -> np.ndarray:
    """Rows of WINDOW + 1 table numbers of one text; rows overlap by one.

    An end stands before the text and one after it. Every number behind the first is a
    target in exactly one row; the last row is filled up with -1."""
    n = -(-(len(words) + 1) // WINDOW)
    held = np.full(n * WINDOW + 1, -1, np.int32)
    held[0], held[1:len(words) + 1], held[len(words) + 1] = 0, words, 0
    return held[np.arange(n)[:, None] * WINDOW + np.arange(WINDOW + 1)]


def _unpacked(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), "<i4").astype(np.int64).reshape(-1, WINDOW + 1)


def _windows_of(column: pa.Array) -> np.ndarray:
    """The windows of a column, all of one size, where they lie."""
    _, offsets, data = column.buffers()
    first = int(np.frombuffer(offsets, np.int32)[column.offset])
    size = len(column) * (WINDOW + 1)
    return np.frombuffer(data, "<i4", size, first).astype(np.int64).reshape(-1, WINDOW + 1)


def _word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) sums by batch over the rows; the end counts once a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        for batch in sliced(batches):
            words, of, sizes = split_words(batch.column("text"))
            count.update(dict(zip(words.to_pylist(), np.bincount(of, minlength=len(words)).tolist())))
            count[END] += len(sizes)
            if len(count) > FLUSH_WORDS:
                yield _counted(count)
                count = Counter()
        if count:
            yield _counted(count)
        give_back()

    return doc_texts(docs).mapInArrow(run, "word binary, n long")


def _counted(count: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([*count], pa.binary()), pa.array([*count.values()], pa.int64())],
                                      ["word", "n"])


def _table_windows(docs: DataFrame, table: Broadcast) -> DataFrame:
    """(window, turn): the windows of all rows, and a number that deals them out evenly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, rare = table.value.get, len(table.value)
        for batch in sliced(batches):
            windows, turns, n = [], [], 0
            words, of, sizes = split_words(batch.column("text"))
            numbers = np.fromiter(map(get, words.to_pylist(), repeat(rare)), np.int32, len(words))[of]
            ends = np.cumsum(sizes)
            for i, a, b in zip(batch.column("doc_id").to_pylist(), (ends - sizes).tolist(), ends.tolist()):
                rows = _windows(numbers[a:b])
                salt = zlib.crc32(b"" if i is None else str(i).encode())
                windows.append(rows)
                turns.append((np.arange(len(rows)) * 2654435761 + salt) % 4294967291)
                n += len(rows)
                if n >= FLUSH_WINDOWS:
                    yield _dealt(windows, turns)
                    windows, turns, n = [], [], 0
            if windows:
                yield _dealt(windows, turns)
        give_back()

    return doc_texts(docs).mapInArrow(run, "window binary, turn long")


def _dealt(windows: list[np.ndarray], turns: list[np.ndarray]) -> pa.RecordBatch:
    rows = np.concatenate(windows).astype("<i4")
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1] * 4)
    held = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])
    return pa.RecordBatch.from_arrays([held, pa.array(np.concatenate(turns))], ["window", "turn"])


def _summed_parts(windows: DataFrame, size: int, work) -> dict[int, np.ndarray]:
    """Sums over all tasks of ``work(batches of windows)``, which gives (key, array) rows.

    Keys number parts of a matrix whose size the table bounds; what is collected is that
    matrix once, after its parts have been added up where they were dealt to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (_windows_of(b.column("window")) for b in batches if b.num_rows)
        for key, values in work(rows):
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([values.astype("<f8").tobytes()])],
                                             ["key", "v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, v in zip(batch.column("key").to_pylist(), batch.column("v").to_pylist()):
                part = np.frombuffer(v, "<f8")
                sums[key] = sums[key] + part if key in sums else part
        for key, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([v.tobytes()])], ["key", "v"])

    parts = windows.select("window").mapInArrow(run, "key long, v binary").repartition("key")
    return {r["key"]: np.frombuffer(bytes(r["v"]), "<f8") for r in parts.mapInArrow(add, "key long, v binary").toLocalIterator()}


def _seed_shares(windows: DataFrame, counts: np.ndarray, kinds: int) -> np.ndarray:
    """Shares of the table in each kind, from the windows in which frequent words meet."""
    top = np.argsort(-counts[1:-1], kind="stable")[:SEED_WORDS] + 1  # neither the end nor the rare entry
    place = np.full(len(counts) + 1, -1)  # the last one: what fills up a window
    place[top] = np.arange(len(top))

    def work(batches: Iterator[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        met = np.zeros((len(top), len(top)))
        for x in batches:
            for k in range(0, len(x), 4096):
                at = place[x[k:k + 4096]]
                bag = np.zeros((len(at), len(top)), np.float32)
                row, col = np.nonzero(at >= 0)
                bag[row, at[row, col]] = 1
                met += bag.T @ bag
        yield from enumerate(met)

    met = np.zeros((len(top), len(top)))
    for key, v in _summed_parts(windows, len(top), work).items():
        met[key] = v
    return kinds_of(met, counts, top, kinds)


def kinds_of(met: np.ndarray, counts: np.ndarray, top: np.ndarray, kinds: int) -> np.ndarray:
    """Clusters of words by whom they meet: positive pointwise information, then k-means
    from centres that are far apart. Rows sum to 1 over the table."""
    out = np.tile(counts / max(1.0, counts.sum()), (kinds, 1))
    if len(top) < kinds:
        return out
    own = np.maximum(np.diag(met), 1)
    total = max(1.0, own.max())
    x = np.log1p(np.maximum(met / own[:, None] / own * total, 0))
    np.fill_diagonal(x, 0)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    centres = [x[0]]
    for _ in range(kinds - 1):
        centres.append(x[np.argmin(np.max(x @ np.array(centres).T, axis=1))])
    c = np.array(centres)
    for _ in range(20):
        of = np.argmax(x @ c.T, axis=1)
        for k in range(kinds):
            if (of == k).any():
                c[k] = x[of == k].mean(0)
                c[k] /= max(1e-9, np.linalg.norm(c[k]))
    for k in range(kinds):
        out[k, top[of == k]] *= 5
    return out / out.sum(1, keepdims=True)


def _shares(windows: DataFrame, shares: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One step of expectation-maximisation: windows are dealt to kinds by their words,
    and the kinds' shares follow from the windows' words."""
    kinds, size = shares.shape
    held = windows.sparkSession.sparkContext.broadcast(np.log(shares + 1e-12).T.astype(np.float32))

    def work(batches: Iterator[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        # one more row: what fills up a window says nothing
        logs = np.concatenate((held.value, np.zeros((1, kinds), np.float32)))
        sums = np.zeros((kinds, size + 1))
        for x in batches:
            for k in range(0, len(x), 4096):
                at = x[k:k + 4096, 1:]
                at = np.where(at < 0, size, at)
                z = logs.take(at.ravel(), 0).reshape(*at.shape, kinds).sum(1)
                z = np.exp(z - z.max(1, keepdims=True))
                z /= z.sum(1, keepdims=True)
                for j in range(kinds):
                    sums[j] += np.bincount(at.ravel(), np.repeat(z[:, j], at.shape[1]), size + 1)
        for lo in range(0, size, PART_WORDS):
            yield lo, sums[:, lo:min(lo + PART_WORDS, size)].ravel()

    out = np.zeros((kinds, size))
    for lo, v in _summed_parts(windows, size, work).items():
        out[:, lo:lo + PART_WORDS] = v.reshape(kinds, -1)
    out = out / np.maximum(out.sum(1, keepdims=True), 1e-9)
    out = (1 - BLEND) * out + BLEND * counts / max(1.0, counts.sum())
    return out / out.sum(1, keepdims=True)


class Spelling:
    """Chances of a word's subword ids: pairs of neighbours, backed off to single ids.

    ``size`` stands for a word's start before its first id and for its end behind the last.
    The most frequent pairs are held; the others, if any, stay in the table at ``path``, and
    ``open_pairs`` names what ``log10`` has to be completed with from there."""

    def __init__(self, rare: DataFrame, codec: Shared, size: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w = words_of(codec)
            keys: list[np.ndarray] = []
            for batch in batches:
                words = [x for x in batch.column("word").to_pylist() if x != END]
                for at in range(0, len(words), FLUSH_WORDS // 4):
                    flat, sizes = w.many(words[at:at + FLUSH_WORDS // 4])
                    keys.append(np.unique(pair_keys(flat, sizes, size), return_counts=True))
            if keys:
                key, n = summed(np.concatenate([k for k, _ in keys]), np.concatenate([c for _, c in keys]))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

        self.path = scratch(rare.sparkSession, "pairs")
        rare.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).write.parquet(self.path)
        pairs = rare.sparkSession.read.parquet(self.path)
        second, first = F.col("key") % (size + 1), F.floor(F.col("key") / (size + 1))
        self.single, self.before, self.size = np.full(size + 1, 0.1), np.zeros(size + 1), size
        for out, column in ((self.single, second), (self.before, first)):
            for r in pairs.groupBy(column.cast("long").alias("id")).agg(F.sum("n").alias("n")).collect():
                out[r["id"]] += r["n"]
        self.single /= self.single.sum()
        # Counts differ in at most the root of twice their sum, so few rows are collected.
        self.least, room, whole = 1, PAIRS, True
        for r in pairs.groupBy("n").agg(F.count("*").alias("pairs")).orderBy(F.col("n").desc()).collect():
            room -= r["pairs"]
            if room < 0:
                self.least, whole = r["n"] + 1, False
                break
        self.whole = whole
        held = pairs.where(F.col("n") >= self.least).orderBy("key").collect()
        self.keys = np.array([r["key"] for r in held], np.int64)
        self.counts = np.array([r["n"] for r in held], np.float64)

    def log10(self, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of each word, whose ids stand one after the other in ``flat``."""
        if not len(sizes):
            return np.empty(0)
        keys = pair_keys(flat, sizes, self.size)
        n = self._held(keys)
        first, second = np.divmod(keys, self.size + 1)
        chance = (n + BACKOFF * self.single[second]) / (self.before[first] + BACKOFF)
        ends = np.cumsum(sizes + 1)
        return np.add.reduceat(np.log10(chance), ends - sizes - 1)

    def _held(self, keys: np.ndarray) -> np.ndarray:
        """The pairs' counts, 0 where none is held."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        return np.where(self.keys[at] == keys, self.counts[at], 0) if len(self.keys) else np.zeros(len(keys))

    def open_pairs(self, flat: np.ndarray, sizes: np.ndarray) -> list[list[dict]]:
        """Of each word, its pairs that aren't held: their keys, and the weights that stand for them in ``log10``."""
        if self.whole or not len(sizes):
            return [[]] * len(sizes)
        keys, ends = pair_keys(flat, sizes, self.size), np.cumsum(sizes + 1)
        at = np.flatnonzero((self._held(keys) == 0) & (self.before[keys // (self.size + 1)] > 0))
        pairs = [{"key": k, "weight": x} for k, x in zip(
            keys[at].tolist(), (BACKOFF * self.single[keys[at] % (self.size + 1)]).tolist())]
        cuts = [0, *np.searchsorted(at, ends).tolist()]
        return [pairs[a:b] for a, b in zip(cuts, cuts[1:])]

    def completed(self, tail: DataFrame) -> DataFrame:
        """Rows (word, spelled, open, ...) with the open pairs' frequencies in ``spelled``, without ``open``."""
        if self.whole:
            return tail.drop("open")
        rest = tail.sparkSession.read.parquet(self.path).where(F.col("n") < self.least)
        pairs = tail.where(F.size("open") > 0).groupBy("word").agg(F.first("open").alias("open")) \
            .select("word", F.explode("open").alias("p")).select("word", "p.key", "p.weight")
        more = pairs.join(rest, "key").groupBy("word").agg(F.sum(F.log10(F.lit(1.0) + F.col("n") / F.col("weight"))).alias("more"))
        return tail.drop("open").join(more, "word", "left") \
            .withColumn("spelled", F.col("spelled") + F.coalesce("more", F.lit(0.0))).drop("more")


def pair_keys(flat: np.ndarray, sizes: np.ndarray, size: int) -> np.ndarray:
    """(id before, id) of all words as one number; before a word and behind it stands ``size``."""
    ends = np.cumsum(sizes + 1)
    second = np.full(int(ends[-1]) if len(ends) else 0, size, np.int64)
    inner = np.ones(len(second), bool)
    inner[ends - 1] = False
    second[inner] = flat
    first = np.roll(second, 1)
    if len(first):
        first[0] = size
    return first * (size + 1) + second


def _train(windows: DataFrame, model: Model, rounds: int, rate: float) -> None:
    """Rounds of local training; a parameter row moves by the mean change of the trainers
    that moved it, weighted by their windows. What is collected is bounded by the vocabulary."""
    spark = windows.sparkSession
    n = windows.count()
    trainers = max(1, n // (WINDOWS_A_TRAINER * rounds))
    width = max(v.shape[1] if v.ndim == 2 else 1 for v in model.p.values())
    for r in range(rounds):
        held = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            source, t = held.value, None
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _windows_of(batch.column("window"))
                if t is None:
                    source._by_word()
                    own = Model.__new__(Model)
                    own.__dict__ |= source.__dict__
                    t = Trainer(own, rate)
                for k in range(0, len(x), BATCH_WINDOWS):
                    t.step(x[k:k + BATCH_WINDOWS])
            moved = [*t.changes()] if t else []
            for k in range(0, len(moved), 5000):
                names, rows, change = zip(*moved[k:k + 5000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(rows, pa.int64()), pa.array([float(t.windows)] * len(rows)),
                     pa.array([np.pad(c, (0, width - len(c))) for c in change],
                              pa.list_(pa.float32()))], ["name", "row", "w", "v"])

        part = windows.where(F.col("turn") % rounds == r).repartition(trainers, F.col("turn")) \
            .sortWithinPartitions(F.xxhash64("window"), "window")
        moved = part.select("window").mapInArrow(run, "name string, row long, w double, v array<float>")
        mean = [(F.sum(F.col("w") * F.col("v")[k]) / F.sum("w")).alias(f"v{k}") for k in range(width)]
        model.p = {k: v.copy() for k, v in model.p.items()}
        for row in moved.groupBy("name", "row").agg(*mean).toLocalIterator():
            p = model.p[row["name"]]
            change = np.array(row[2:], np.float32)
            p[row["row"]] += change[:p.shape[1]] if p.ndim == 2 else change[0]


class Corpus:
    """What has been gathered: stored word counts, totals, the table and the models."""

    def __init__(self, docs: DataFrame, codec: Shared, folds: int, held: int, rounds: int, rate: float):
        spark = docs.sparkSession
        self.path = path = scratch(spark, "lm")
        own = docs.where(id_fold(folds) != held)
        _word_counts(own).groupBy("word").agg(F.sum("n").alias("n")).write.parquet(f"{path}/counts")
        self.counts = spark.read.parquet(f"{path}/counts")
        row = self.counts.agg(F.sum("n"), F.count("*"), F.count_if(F.col("n") == 1)).first()
        self.n, self.v = row[0] or 0, row[1]
        bound = max(MIN_COUNT, -(-self.n // HOT_SHARE))
        end = F.col("word") == F.lit(END)
        hot = self.counts.where((F.col("n") >= bound) | end).orderBy(end.desc(), F.col("n").desc(), "word").collect()
        self.hot = [(bytes(r["word"]), r["n"]) for r in hot] or [(END, 1)]
        self.rare = self.counts.where((F.col("n") < bound) & ~end)
        self.n_rare = self.n - sum(n for _, n in hot)
        # Of the rare tokens, the share that a word seen once makes up stands for unseen words.
        self.unseen = min(0.9, max(0.01, row[2] / self.n_rare)) if self.n_rare > 0 else 1.0
        self.table = spark.sparkContext.broadcast({w: k for k, (w, _) in enumerate(self.hot)})
        totals = np.array([n for _, n in self.hot] + [max(1, self.n_rare)], np.float64)
        _table_windows(own, self.table).write.parquet(f"{path}/windows")
        windows = spark.read.parquet(f"{path}/windows")
        shares = _seed_shares(windows, totals, KINDS)
        for _ in range(2):
            shares = _shares(windows, shares, totals)
        w, size = words_of(codec), len(codec.get().table)
        flat, sizes = w.many([x for x, _ in self.hot[1:]])
        parts = np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []
        self.model = Model([np.array([w.end]), *parts, np.empty(0, np.int64)], shares, size)
        _train(windows, self.model, rounds, rate)
        self.spelling = Spelling(self.rare, codec, size)


def score(docs: DataFrame, vocabulary: str = VOCABULARY, folds: int = FOLDS, held: int = HELD_FOLD,
          rounds: int = ROUNDS, rate: float = RATE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_rare.

    One row per input row. A null text is empty: its only token is the end. Rows with a
    null id are trained on. Without training rows all counts are zero, and the model
    knows the end and spellings of equal chances only. ``n_rare`` counts tokens outside
    the model's table.
    """
    spark: SparkSession = docs.sparkSession
    codec = shared_codec(docs, vocabulary)
    corpus = Corpus(docs, codec, folds, held, rounds, rate)
    space = np.log10(corpus.n + corpus.v + 1)
    gains = np.log10(np.array([n + 1 if corpus.n else 1 for _, n in corpus.hot], np.float64))
    known, spelling = (spark.sparkContext.broadcast(x) for x in ((gains, corpus.model), corpus.spelling))
    table, trained = corpus.table, corpus.n > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (gain, model), get = known.value, table.value.get
        rare, vectors = len(table.value), model.vectors(np.arange(len(model.sizes)))
        gain = np.append(gain, 0.0)
        for batch in sliced(batches):
            words, of, sizes = split_words(batch.column("text"))
            number = np.fromiter(map(get, words.to_pylist(), repeat(rare)), np.int64, len(words))
            at, owner, ends = number[of], np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes + 1)
            seq = np.zeros(len(at) + len(sizes), np.int64)  # each text's words and its end
            inner = np.ones(len(seq), bool)
            inner[ends - 1] = False
            seq[inner] = at
            base = np.bincount(owner, gain[at], len(sizes)) + gain[0] - (sizes + 1) * space
            docs_, scores, first = np.split(seq, ends[:-1]), [], 0
            while first < len(docs_):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] - sizes[first] - 1 + SCORE_TOKENS, "right")))
                scores.append(model.score(docs_[first:last], vectors))
                first = last
            own = np.flatnonzero(at == rare)
            own = own[np.argsort(of[own], kind="stable")]
            tail = np.flatnonzero(number == rare)  # each word has a token at least
            cuts = np.append(0, np.cumsum(np.bincount(of[own], minlength=len(words))[tail])).astype(np.int32)
            rids = batch.column("rid").to_numpy()
            pad = lambda x, t: pa.concat_arrays([pa.array(x, t), pa.nulls(len(tail), t)])
            yield pa.RecordBatch.from_arrays(
                [pad(rids, pa.int64()), pad(batch.column("doc_id"), pa.int64()), pad(sizes + 1, pa.int64()),
                 pad(np.bincount(owner[own], minlength=len(sizes)), pa.int64()), pad(base, pa.float64()),
                 pad(np.concatenate(scores), pa.float64()),
                 pa.concat_arrays([pa.nulls(len(sizes), pa.binary()), words.take(pa.array(tail))]),
                 pa.concat_arrays([pa.nulls(len(sizes), pa.list_(pa.int64())),
                                   pa.ListArray.from_arrays(pa.array(cuts), pa.array(rids[owner[own]], pa.int64()))])],
                ["rid", "doc_id", "n_tokens", "n_rare", "base", "score", "word", "rids"])
        give_back()

    def spell(words: pa.Array) -> pa.Array:
        coded = words.dictionary_encode()
        flat, sizes = words_of(codec).many(coded.dictionary.to_pylist())
        log10, open_ = spelling.value.log10(flat, sizes), spelling.value.open_pairs(flat, sizes)
        parts = [pa.array(log10, pa.float64()), pa.array(open_, OPEN)]
        return pa.StructArray.from_arrays(parts, fields=[*SPELLED]).take(coded.indices)

    doc_texts(docs).withColumn("rid", F.monotonically_increasing_id()).mapInArrow(
        run, "rid long, doc_id long, n_tokens long, n_rare long, base double, score double, word binary, "
             "rids array<long>").write.parquet(f"{corpus.path}/scored")
    scored = spark.read.parquet(f"{corpus.path}/scored")
    own = F.coalesce("n", F.lit(0)) * ((1 - corpus.unseen) / max(1, corpus.n_rare))
    chance = own + F.pow(F.lit(10.0), "spelled") * corpus.unseen
    spelled = F.arrow_udf(spell, "spelled double, open array<struct<key: long, weight: double>>")
    tail = scored.where("word IS NOT NULL").select("word", "rids").join(corpus.rare, "word", "left") \
        .withColumn("s", spelled("word")).select("word", "rids", "n", "s.spelled", "s.open")
    tail = corpus.spelling.completed(tail if corpus.spelling.whole else stored(tail)).select(
        F.explode("rids").alias("rid"), F.log10(F.coalesce("n", F.lit(0)) + 1).alias("gain"),
        F.col("n").isNotNull().cast("long").alias("seen"), F.log10(F.greatest(chance, F.lit(1e-300))).alias("cost"))
    sums = tail.groupBy("rid").agg(F.sum("gain").alias("gain"), F.sum("seen").alias("seen"), F.sum("cost").alias("cost"))
    rows = scored.where("word IS NULL").drop("word", "rids").join(sums, "rid", "left")
    in_table = (F.col("n_tokens") - F.col("n_rare")) if trained else F.lit(0)
    return rows.select(
        "doc_id", (id_fold(folds) == held).alias("held_out"), "n_tokens",
        (in_table + F.coalesce("seen", F.lit(0))).cast("long").alias("n_known"),
        F.lit(corpus.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("gain", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("cost", F.lit(0.0))).alias("score"), "n_rare")
