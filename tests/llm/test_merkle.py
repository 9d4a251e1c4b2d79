"""Merkle manifest against a plain recursion, over several rounds of superblocks, and odd rows."""
import hashlib
import zlib

import duckdb
from pyspark.sql import functions as F

from bursa.llm import merkle
from bursa.llm.common import table
from bursa.llm.queries import OP13_SQL

SF_SMALL = "/root/testdata/sf0.001"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, add=0):
    n = None if r.n_chars is None else r.n_chars + add
    fields = [r.doc_id, r.source, r.lang, n, r.text]
    return sha(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def up(nodes):
    """Levels of a tree, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def walk(levels, i):
    """(place in its run, siblings) from leaf i up."""
    for level in levels[:-1]:
        run = level[i - i % 2:i - i % 2 + 2]
        yield i % 2, [h for k, h in enumerate(run) if k != i % 2]
        i //= 2


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r.lang, []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by[lang].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        trees[lang] = up([leaf(r) for r in by[lang]])
    top = up([trees[x][-1][0] for x in langs])
    root, out = (top[-1][0] if langs else None), []
    for k, lang in enumerate(langs):
        for i, r in enumerate(by[lang]):
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            node, proof = leaf(r, 1 if hit else 0), ""
            for place, siblings in [*walk(trees[lang], i), *walk(top, k)]:
                proof += "".join(siblings)
                node = sha(*siblings, node) if place else sha(node, *siblings)
            out.append((r.doc_id, leaf(r), trees[lang][-1][0], root, sha(proof), node, node == root))
    return out


def check(docs, **options):
    got = [tuple(r)[:7] for r in merkle.manifest(docs, merkle.tampered_hash(), **options).collect()]
    want = brute(docs.collect())
    assert sorted(got, key=str) == sorted(want, key=str)
    return got


def test_given_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    got = check(docs)
    assert {r[6] for r in got} == {True, False} and len({r[3] for r in got}) == 1
    assert check(docs, height=3)  # several rounds up and down
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    assert sorted(r[:7] for r in con.sql(OP13_SQL).fetchall()) == sorted(got)
    unchanged = merkle.manifest(docs).collect()
    assert all(r.verified and r.folded_root == r.root for r in unchanged)


def test_sizes_and_odd_rows(spark, make_docs):
    for n, height in ((1, 1), (2, 12), (3, 1), (5, 2), (8, 2), (9, 2)):
        check(make_docs([(k, f"t{k}") for k in range(n)]), height=height)
    odd = [(1, None), (2, ""), (None, "x", None), (None, "y", None), (3, "a", ""), (3, "a", ""), (3, "b", ""),
           (-5, "é 日本", "日本"), (4, "long " * 300_000, "de"), (2 ** 62 + 1, "big", None)]
    docs = make_docs(odd, ("key", "pos", "n", "hash", "task", "at", "shown"))
    docs = docs.withColumn("n_chars", F.when(F.col("doc_id") == 3, None).otherwise(F.col("n_chars")))
    got = check(docs, height=1)
    assert sorted(str(r[0]) for r in got) == sorted(str(r[0]) for r in odd)
    assert merkle.manifest(make_docs([])).collect() == []
    (one,) = merkle.manifest(make_docs([(9, "only")])).collect()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == sha("")


def test_same_roots_however_stored(spark, make_docs):
    rows = [(k % 50, f"t{k}", "en" if k % 3 else None) for k in range(200)]
    roots = {merkle.manifest(make_docs(r).repartition(p), height=2).first().root
             for r, p in ((rows, 1), (rows[::-1], 5), (rows[100:] + rows[:100], 3))}
    assert len(roots) == 1
