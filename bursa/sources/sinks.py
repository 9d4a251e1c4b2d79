"""Writers: append (A-08), market-cap bulk load (A-09), upsert (A-21) and merge of resent records (T-02).

Tables are partitioned Parquet. ``upsert`` rewrites only the partitions touched by
the update rows (dynamic partition overwrite): existing rows of those partitions
whose key is not updated are kept, the update rows replace the rest. One shuffle, by
partition and a few buckets of keys, serves the choice and the write.
The job reads the old partition files and commits new ones only at the end, so a
lost executor just re-runs its tasks against unchanged input.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bursa.operators.latest import latest_per_key
from bursa.sources.schemas import PARTITION_COLUMNS, SCHEMAS, SYMBOL, validate, with_partitions


BUCKETS = 8  # tasks that share a partition, and files it is written in, per shuffle


def _exists(df: DataFrame, path: str) -> bool:
    jvm = df.sparkSession._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    return fs.exists(jpath) and any(True for _ in fs.listStatus(jpath))


def append(df: DataFrame, path: str, table: str | None = None,
           partition_by: Sequence[str] | None = None, batch_id: int | None = None,
           run: str | None = None) -> None:
    """``INSERT INTO ... VALUES`` as an append, after a schema check when ``table`` is named.

    With a ``batch_id`` (a stream's micro-batch) the rows go to that batch's own folder,
    which is replaced as a whole, so a batch that is written again adds nothing. ``run``
    names the stream (its query id): batch ids of different streams, and of one that
    begins anew with another checkpoint, both start at 0.
    """
    if table is not None:
        df = with_partitions(validate(df, table), table)
        partition_by = partition_by if partition_by is not None else PARTITION_COLUMNS.get(table)
    w = df.write.mode("append")
    if batch_id is not None:
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        path = f"{path}/run_id={run or 'batch'}/batch_id={batch_id}"
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_clustered(df: DataFrame, table: str, name: str, path: str | None = None, buckets: int = 64) -> DataFrame:
    """Store a market table bucketed by its symbol besides its date partitions, as the
    catalog table ``name``, and return it.

    Tables with equal ``buckets`` are joined, grouped and windowed by symbol without an
    exchange: a task reads one bucket's files of the partitions that survive pruning. The
    rows are dealt out by bucket before the write, so a task writes few files; with many
    small partitions choose few buckets, as each holds a file per partition."""
    df, symbol = with_partitions(validate(df, table), table), SYMBOL[table]
    parts = PARTITION_COLUMNS.get(table, [])
    w = df.repartition(buckets, symbol).write.mode("overwrite").format("parquet") \
        .bucketBy(buckets, symbol).sortBy(symbol)
    if parts:
        w = w.partitionBy(*parts)
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def load_market_cap(raw: DataFrame, path: str | None = None) -> DataFrame:
    """A-09: cast a raw market-cap frame to the declared schema, rounding fractional
    capitalisations half up as an assignment to a BIGINT column does."""
    out = raw.select(
        F.col("code").cast("string"), F.col("listed_stocks").cast("string"),
        F.round(F.col("number_of_listed_shares").cast("decimal(38,4)"), 0).cast("bigint")
        .alias("number_of_listed_shares"),
        F.round(F.col("market_capitalization").cast("decimal(38,4)"), 0).cast("bigint")
        .alias("market_capitalization"),
        F.col("percentage").cast("decimal(9,4)"), F.col("month").cast("int"), F.col("year").cast("int"))
    out = validate(out, "market_cap")
    if path is not None:
        append(out, path, partition_by=["year"])
    return out


def upsert(updates: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str],
           order: Sequence[Column | str] | None = None) -> None:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE``: update rows replace stored rows
    with the same key, other stored rows stay. Only touched partitions are rewritten.

    ``partition_by`` must be determined by ``keys`` (key columns, or columns derived
    from them) so that a key lives in exactly one partition. Of several update rows with
    one key the first under ``order`` wins; without it the largest by the other columns,
    so the outcome never depends on the row order. Null is a key value like any other.
    """
    spark, columns = updates.sparkSession, updates.columns
    order = order or [F.col(c).desc() for c in columns if c not in keys] or list(keys)
    if set(keys) <= set(partition_by):  # a partition holds one key: the updates replace it
        (latest_per_key(updates, list(keys), order).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
        return
    held = updates.is_cached  # the caller's, who goes on reading it
    upd = updates if held else updates.persist()  # read twice below
    rows, exists = upd.withColumn("__new", F.lit(True)), _exists(updates, path)
    if exists:
        current, touched = spark.read.schema(upd.schema).parquet(path), upd.select(*partition_by).distinct()
        same = [current[c].eqNullSafe(touched[c]) for c in partition_by]
        rows = rows.unionByName(current.join(F.broadcast(touched), same, "left_semi").withColumn("__new", F.lit(False)))
    # The window's keys hold the shuffle's, so it needs no other one.
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))).repartition(*partition_by, "__bucket")
    w = Window.partitionBy(*partition_by, "__bucket", *[c for c in keys if c not in partition_by])
    merged = rows.withColumn("__rn", F.row_number().over(w.orderBy(F.col("__new").desc(), *order))) \
        .where(F.col("__rn") == 1).select(*columns)
    writer = merged.write.mode("overwrite")
    if exists:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)
    if not held:
        upd.unpersist()


def merge_records(records: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str], rank: str) -> None:
    """Fill each key's row from all records of it, whenever they arrive.

    A column holds the value of the record with the highest ``rank`` that has one (of
    equal ranks the largest value), so a record that comes hours later completes the row
    and one that is sent again changes nothing. Only the touched partitions are read and
    rewritten; ``partition_by`` must be part of ``keys``. Writing a batch again gives the
    same table. Records with a null key are refused, as they name no row.
    """
    spark = records.sparkSession
    for k in keys:
        records = records.where(F.col(k).isNotNull())
    new = records.persist()  # read twice below
    rows = new
    if _exists(new, path):
        touched = new.select(*partition_by).distinct()
        stored = spark.read.schema(new.schema).parquet(path)
        rows = new.unionByName(stored.join(touched, list(partition_by), "left_semi"))

    def best(c: str) -> Column:
        return F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(rank), F.col(c).alias("v"))))["v"].alias(c)

    merged = rows.groupBy(*keys).agg(*[best(c) for c in new.columns if c not in keys and c != rank],
                                     F.max(rank).alias(rank)).select(*new.columns)
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(*partition_by).parquet(path))
    new.unpersist()


def table_path(base: str, name: str) -> str:
    return os.path.join(base, name)


__all__ = ["append", "load_market_cap", "merge_records", "save_clustered", "upsert", "table_path", "SCHEMAS"]
