"""Key and NOT NULL audits (A-22, A-23).

Both audits are one grouped pass: key violations are a ``groupBy(keys).count()``
with map-side partial counts, null counts a single global aggregate of
``count_if`` expressions (one row out, no shuffle of data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (A-22)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def key_violation_counts(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per table: duplicated keys and surplus rows (0 and 0 when the key holds)."""
    parts = []
    for name, (df, keys) in tables.items():
        v = key_violations(df, keys)
        parts.append(v.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                           F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"))
                     .select(F.lit(name).alias("table_name"), "duplicate_keys", "surplus_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_violations(df: DataFrame, cols: Sequence[str], table: str = "") -> DataFrame:
    """NULL count of each NOT NULL column in one pass (A-23): rows (table, column, nulls)."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot([], list(cols), "column_name", "null_count")
    return long.select(F.lit(table).alias("table_name"), "column_name", F.col("null_count").cast("bigint"))


def not_null_columns(schema) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]
