"""Coverage and data-quality reports (K-01..K-05, K-08, K-09, K-13, K-14).

All reports are single-pass aggregates (partial aggregation before the shuffle);
the table-count report is a union of one-row aggregates (G-01).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bursa import constants as K

from bursa.operators.latest import as_of_text, max_data_date


def table_counts(tables: dict[str, DataFrame], col: str = "ts") -> DataFrame:
    """K-01: ``COUNT(ts)`` of each table, one row per table, sorted by name."""
    parts = [df.agg(F.count(col).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name")


def coverage(df: DataFrame, label: str, code: str = "security_code", day: str = "data_date") -> DataFrame:
    """K-02 / K-04: symbols, first and last date, and rows of a table."""
    return df.agg(
        F.lit(label).alias("table_name"),
        F.count_distinct(code).alias("stock_count"),
        F.min(day).alias("earliest_date"),
        F.max(day).alias("latest_date"),
        F.count(F.lit(1)).alias("total_records"),
    )


def coverage_on(summary: DataFrame, as_of=None, label: str = "today_stock_summary") -> DataFrame:
    """K-03: symbols and rows on one day (default ``CURRENT_DATE``)."""
    d = as_of_text(as_of)
    s = summary.where(F.col("data_date") == d)
    return s.agg(F.lit(label).alias("table_name"), F.count_distinct("security_code").alias("stock_count"),
                 F.count(F.lit(1)).alias("total_records"))


def sample_latest(summary: DataFrame, n: int = K.TOP_LIST_SIZE) -> DataFrame:
    """K-05: the ``n`` rows of the latest date with the largest traded value."""
    s = summary.where(F.col("data_date") == max_data_date(summary))
    return (s.select("security_code", "data_date", "data_time", "opening_price", "highest_price",
                     "lowest_price", "close_price", "trade_volume", "trade_value", "ts")
             .orderBy(F.col("trade_value").desc(), "security_code", F.col("ts").desc())
             .limit(n).drop("ts"))


def latest_date(summary: DataFrame) -> DataFrame:
    """K-08: latest date and symbol count."""
    return summary.agg(F.lit("Latest stock_summary date").alias("info"),
                       F.max("data_date").alias("latest_date"),
                       F.count_distinct("security_code").alias("stock_count"))


def date_match(summary: DataFrame, as_of=None) -> DataFrame:
    """K-09: does the as-of day (default ``CURRENT_DATE``) have data."""
    d = as_of_text(as_of)
    s = summary.where(F.col("data_date") == d)
    return s.agg(F.count_distinct("security_code").alias("stock_count_today")).select(
        F.lit("Current date match").alias("info"), F.to_date(d, "yyyyMMdd").alias("current_date"),
        d.alias("formatted_current_date"), "stock_count_today")


def _active_history(history: DataFrame, as_of: Column | None, days: int) -> DataFrame:
    anchor = F.current_date() if as_of is None else as_of
    return history.where(F.col("trade_date") >= F.date_sub(anchor, days))


def missing_fundamentals(history: DataFrame, fundamentals: DataFrame, as_of: Column | None = None, *,
                         days: int = K.HISTORY_LOOKBACK_DAYS, min_value=1_000_000_000,
                         n: int = K.MISSING_LIST_SIZE) -> DataFrame:
    """K-13: active symbols (last ``days`` days, value > ``min_value``) without
    fundamentals, top ``n`` by average daily value. Anti-join (C-04)."""
    h = _active_history(history, as_of, days).where(F.col("value") > F.lit(int(min_value)))
    miss = h.join(fundamentals, h.code == fundamentals.security_code, "left_anti")
    out = miss.groupBy(F.col("code").alias("security_code")).agg(
        F.count_distinct("trade_date").alias("days_of_data"),
        F.max("trade_date").alias("latest_date"),
        F.max("close").alias("latest_close_price"),
        (F.sum(F.col("value").cast("decimal(30,0)")).cast("double") / F.count("value").cast("double"))
        .alias("avg_daily_value"),
        F.lit("MISSING - Add to stock_fundamentals table").alias("status"),
    )
    return out.orderBy(F.col("avg_daily_value").desc(), "security_code").limit(n)


def fundamentals_coverage(history: DataFrame, fundamentals: DataFrame, as_of: Column | None = None,
                          days: int = K.HISTORY_LOOKBACK_DAYS) -> DataFrame:
    """K-14: symbols in recent history, how many have fundamentals, how many lack them (C-08)."""
    h = _active_history(history, as_of, days).select("code")
    f = fundamentals.select(F.col("security_code").alias("sf_code"))
    j = h.join(f, h.code == f.sf_code, "left")
    return j.agg(F.count_distinct("code").alias("total_stocks_in_history"),
                 F.count_distinct("sf_code").alias("stocks_with_fundamentals")) \
            .withColumn("missing_fundamentals",
                        F.col("total_stocks_in_history") - F.col("stocks_with_fundamentals"))
