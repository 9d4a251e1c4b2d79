"""Merkle manifest of a dataset: leaf, subroot and root hashes, proofs, and their check.

Every row is a leaf. The leaves of a language, in ascending ``doc_id``, form a binary
tree whose last node is the subroot; the subroots, ordered by language, form the tree of
the root. A node is the sha256, as lowercase hex, of its one or two children's hex.

Trees are cut into superblocks of ``2 ** HEIGHT`` consecutive nodes. Going up, each
superblock is reduced in one group, and its result is a node of the next, 4,096 times
smaller round. Going down, a superblock's nodes are cogrouped with the one row of outer
nodes that its result needs to reach the root: one group then reduces its nodes again,
joins the proofs and, for leaves, folds them. No group holds more than a superblock and
no tree is held whole anywhere.

Null ids sort first; rows with equal ids are ordered by their leaf hash, so equal tables
give equal roots however their rows are stored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bursa.llm.common import stored

HEIGHT = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 7
RESULT = ("doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean, position long")


def _sha(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def leaf_hash(**changed: Column) -> Column:
    """sha256 over each field as ``-`` (null) or byte count, ``:`` and value."""
    def part(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*map(part, FIELDS)), 256)


def tampered_hash() -> Column:
    """The leaf after adding 1 to n_chars, where 7 divides the crc32 of the id; else null."""
    hit = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % TAMPER_EVERY == 0
    return F.when(hit, leaf_hash(n_chars=F.col("n_chars") + 1))


def positions(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place within its ``key``, and ``n``, the key's rows.

    A range sort splits even one huge key over many tasks; it is stored with each row's
    task and place there, and a small table of rows per key and task gives the offsets."""
    ordered = stored(rows.orderBy(key, *order).select(
        "*", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at")))
    runs = ordered.groupBy(key, "task").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    w = Window.partitionBy(key)
    before = w.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(runs.select(key, "task", "first", F.sum("rows").over(w).alias("n"),
                              F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before")))
    return ordered.join(runs, [key, "task"]).withColumn("pos", F.col("at") - F.col("first") + F.col("before")) \
        .drop("task", "at", "first", "before")


def _levels(hashes: list[str], n: int, height: int) -> list[list[str]]:
    """A superblock's nodes, level by level: up to the tree's top if it is the only one,
    else ``height`` levels, in which a node without a neighbour is hashed alone."""
    levels = [hashes]
    while len(levels[-1]) > 1 if n <= 1 << height else len(levels) <= height:
        row = levels[-1]
        levels.append([_sha("".join(row[i:i + 2])) for i in range(0, len(row), 2)])
    return levels


def _paths(levels: list[list[str]], sides: str, proof: str) -> list[tuple[str, str]]:
    """(sides, siblings' hex) from each node of the lowest level to the root, the given ones outside.

    A side is L or R for a left or right node of two, S for a node that is hashed alone."""
    up = [(sides, proof)]
    for row in reversed(levels[:-1]):
        down = []
        for i, _ in enumerate(row):
            outer_sides, outer = up[i >> 1]
            if i ^ 1 < len(row):
                down.append(("LR"[i & 1] + outer_sides, row[i ^ 1] + outer))
            else:
                down.append(("S" + outer_sides, outer))
        up = down
    return up


def fold(node: str, sides: str, proof: str) -> str:
    """The root that a node and its proof lead to."""
    at = 0
    for side in sides:
        sibling = "" if side == "S" else proof[at:at + 64]
        at += len(sibling)
        node = _sha(sibling + node if side == "R" else node + sibling)
    return node


def _climb(nodes: DataFrame, height: int) -> list[DataFrame]:
    """Rounds of (key, pos, n, hash), each a superblock's result of the one before."""
    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        n = int(pdf["n"].iloc[0])
        top = _levels(pdf["hash"].tolist(), n, height)[-1][0]
        return pd.DataFrame({"key": [pdf["key"].iloc[0]], "pos": [pdf["block"].iloc[0]],
                             "n": [-(-n >> height)], "hash": [top]})

    rounds = [nodes.select("key", "pos", "n", "hash")]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        blocks = rounds[-1].withColumn("block", F.shiftright("pos", height)).groupBy("key", "block")
        rounds.append(stored(blocks.applyInPandas(reduce, "key string, pos long, n long, hash string")))
    return rounds


def _exchange(nodes: DataFrame, outer: DataFrame, height: int, work, schema: str) -> DataFrame:
    """``work(nodes in order, their paths, outer row)`` for every superblock and its outer nodes."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame()
        left, row = left.sort_values("pos"), right.iloc[0]
        levels = _levels(left["hash"].tolist(), int(left["n"].iloc[0]), height)
        return work(left, _paths(levels, row["sides"], row["proof"]), row)

    blocks = nodes.withColumn("block", F.shiftright("pos", height)).groupBy("key", "block")
    return blocks.cogroup(outer.withColumnRenamed("pos", "block").groupBy("key", "block")).applyInPandas(run, schema)


OUTER = "key string, pos long, sides string, proof string, subroot string, root string"


def _outer(pdf: pd.DataFrame, paths: list[tuple[str, str]], row: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"key": pdf["key"], "pos": pdf["pos"], "sides": [s for s, _ in paths],
                         "proof": [p for _, p in paths], "subroot": row["subroot"], "root": row["root"]})


def _fold_leaves(pdf: pd.DataFrame, paths: list[tuple[str, str]], row: pd.Series) -> pd.DataFrame:
    shown = [t if isinstance(t, str) else h for t, h in zip(pdf["shown"], pdf["hash"])]
    folded = [fold(h, s, p) for h, (s, p) in zip(shown, paths)]
    return pd.DataFrame({
        "doc_id": pdf["doc_id"], "leaf": pdf["hash"], "subroot": row["subroot"], "root": row["root"],
        "proof_sha256": [_sha(p) for _, p in paths], "folded_root": folded,
        "verified": [f == row["root"] for f in folded], "position": pdf["pos"]})


def leaves(docs: DataFrame, shown: Column | None = None) -> DataFrame:
    """(key, pos, n, hash, doc_id, shown) of every row; ``key`` orders like lang, null first.

    ``shown`` is the leaf hash that a row shows to the check (null: its own)."""
    key = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("lang")))
    rows = stored(docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                              leaf_hash().alias("hash"),
                              (F.lit(None) if shown is None else shown).cast("string").alias("shown")))
    return positions(rows, "key", ["doc_id", "hash"])


def manifest(docs: DataFrame, shown: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """One row per input row: doc_id, leaf, subroot, root, proof_sha256, folded_root,
    verified, position (place within the language).

    ``proof_sha256`` hashes the siblings from leaf to root; ``folded_root`` is what the
    shown leaf and those siblings lead to, and ``verified`` whether that is the root.
    Null fields count as ``-``, empty texts as ``0:``; null languages form the first
    tree, null ids come first in theirs; repeated rows are leaves of their own; a table
    of one row has its leaf as subroot and root and an empty proof; an empty table gives
    no row. Only the five fields are read."""
    nodes = leaves(docs, shown)
    rounds = _climb(nodes, height)
    trees = positions(rounds[-1].select(F.lit("").alias("key"), F.col("key").alias("tree"), "hash"), "key", ["tree"])
    tops = _climb(trees, height)
    outer = tops[-1].select("key", "pos", F.lit("").alias("sides"), F.lit("").alias("proof"),
                            F.lit("").alias("subroot"), F.col("hash").alias("root"))
    for level in reversed(tops[:-1]):
        outer = stored(_exchange(level, outer, height, _outer, OUTER))
    outer = outer.join(trees.select("pos", "tree", F.col("hash").alias("own")), "pos") \
        .select(F.col("tree").alias("key"), F.lit(0).cast("long").alias("pos"), "sides", "proof",
                F.col("own").alias("subroot"), "root")
    for level in reversed(rounds[1:-1]):
        outer = stored(_exchange(level, outer, height, _outer, OUTER))
    # Ids pass through pandas as text, which holds null and any long.
    nodes = nodes.withColumn("doc_id", F.col("doc_id").cast("string"))
    return _exchange(nodes, outer, height, _fold_leaves, RESULT).withColumn("doc_id", F.col("doc_id").cast("long"))
