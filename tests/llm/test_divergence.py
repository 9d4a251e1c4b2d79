"""Source divergences against SQL and a plain count, with small shards and blocks, and odd rows."""
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from bursa.llm import divergence
from bursa.llm.common import table
from bursa.llm.queries import OP12_SQL

SF_SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, top=200):
    counts, docs, groups = Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = Counter(TERM.findall(lower))
        for t, n in terms.items():
            counts[lang, source, t] += n
            docs[lang, t] += 1
    out = []
    for lang in {g[0] for g in groups}:
        sources = sorted(s for x, s in groups if x == lang)
        kept = [t for (x, t), n in docs.items() if x == lang and n >= 3]
        total = {s: sum(counts[lang, s, t] for t in kept) for s in sources}
        p = {(s, t): 1 + 10 ** 9 * (counts[lang, s, t] + 1) // (total[s] + len(kept)) for s in sources for t in kept}
        every = sum(total.values())
        q = {t: 1 + 10 ** 9 * (sum(counts[lang, s, t] for s in sources) + 1) // (every + len(kept)) for t in kept}
        for a in sources:
            pairs = [(-sum((p[a, t] - p[b, t]) ** 2 // p[b, t] for t in kept), b) for b in sources if b != a]
            terms = [(-((p[a, t] - q[t]) ** 2 // q[t]), t) for t in kept if counts[lang, a, t] and p[a, t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, a, part, item, -v, k) for k, (v, item) in enumerate(found, 1)]
    return sorted(out)


def got(docs, **options):
    return sorted(tuple(r) for r in divergence.divergences(docs, **options).collect())


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 40)
    monkeypatch.setattr(divergence, "MERGE_ROWS", 50)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 1000)


def test_equals_sql_and_plain_counts(spark):
    docs = table(spark, SF_SMALL, "documents")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    want = sorted(con.sql(OP12_SQL).fetchall())
    assert got(docs) == want
    assert want == brute([(r.lang, r.source, r.text) for r in docs.collect()])


def test_small_shards(spark):
    docs = table(spark, SF_SMALL, "documents")
    assert got(docs.repartition(5), shard_terms=30, top=5) == brute([(r.lang, r.source, r.text) for r in docs.collect()], 5)


def test_pieces_of_long_texts(small):
    text = ("Ab,cd é日 " * 700 + "x" * 3000 + " Zz").encode()
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"lang": ["l"], "source": ["s"], "text": pa.array([text], pa.binary())})
    counts = {r["term"]: (r["n"], r["docs"]) for r in divergence._batch_counts(batch).to_pylist()}
    assert counts == {"ab": (700, 1), "cd": (700, 1), "é日": (700, 1), "x" * 3000: (1, 1), "zz": (1, 1)}


def test_scaled_is_exact():
    rng = np.random.default_rng(1)
    total = rng.integers(1, 8 * 10 ** 15, 2000)
    count = (total * rng.random(2000)).astype(np.int64)
    assert divergence.scaled(count, total).tolist() == [1 + 10 ** 9 * int(c) // int(t) for c, t in zip(count, total)]
    whole = np.array([10 ** 15, 7])
    assert divergence.scaled(whole, whole).tolist() == [1 + 10 ** 9] * 2


def test_odd_rows(spark):
    rows = [("en", "a", None), ("en", "b", ""), (None, None, "x y"), (None, "", "x y"), ("", None, "x z z"),
            ("en", "a", "Word word WORD naïve"), ("en", "b", "word 123 naïve"), ("en", "c", "naïve word"),
            ("en", "c", "naïve word"), ("de", "only", "ja ja"), ("fr", "p", "1 2 3"), ("fr", "q", None),
            ("en", "long", "tie a " * 300_000), ("en", "a", "tie a"), ("en", "b", "tie a")]
    schema = "lang string, source string, text string, n long, docs long, term string, shard int"
    docs = spark.createDataFrame([(*r, 7, 7, "t", 7) for r in rows], schema)
    want = brute(rows)
    assert got(docs) == want
    assert ("fr", "p", "pair", "q", 0, 1) in want and not any(r[0] == "de" for r in want)
    assert got(spark.createDataFrame([], schema)) == []
