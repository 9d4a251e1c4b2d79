"""Momentum-rebound screens (S-01..S-18) and the rebound diagnostics (K-06, K-07).

Physical shape: every input is reduced to one row per symbol *before* the joins
(latest snapshot, previous day, volume average), so the joins are between small
per-symbol frames; AQE turns them into broadcast joins once their runtime size is
known, and nothing is broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bursa import constants as K

from bursa.functions.expr import mark, score, text_day, ratio
from bursa.operators import candle as C
from bursa.operators.latest import (as_of_text, eod_snapshots, latest_per_key, latest_snapshot,
                                    latest_via_partition, max_data_date, prefer)

REBOUND_FLAGS = ["is_down_from_open", "has_long_lower_shadow", "has_volume_surge", "is_liquid",
                 "is_near_support"]


# --- building blocks ------------------------------------------------------------------------

def previous_day(summary: DataFrame, before: Column) -> DataFrame:
    """S-01: last snapshot strictly before ``before`` (yyyyMMdd text) per symbol."""
    s = summary.where((F.col("data_date") < before) & F.col("lowest_price").isNotNull()
                      & F.col("trade_volume").isNotNull())
    # the whole history before the date is a candidate: locate each symbol's last day with a
    # narrow pass, then read full rows from those days' partitions only
    last = latest_via_partition(s, ["security_code"], [F.col("data_date").desc(), F.col("ts").desc()],
                                "data_date", F.max("data_date"))
    return last.select("security_code", F.col("data_date").alias("prev_trade_date"),
                       F.col("lowest_price").alias("previous_low"),
                       F.col("trade_volume").alias("prev_volume"))


def previous_day_history(history: DataFrame) -> DataFrame:
    """S-02: last complete bar per code from the history table."""
    h = history.where(F.col("close").isNotNull() & F.col("low").isNotNull() & F.col("volume").isNotNull())
    last = latest_per_key(h, ["code"], [F.col("trade_date").desc()])
    return last.select(F.col("code").alias("security_code"), F.col("trade_date").alias("prev_trade_date"),
                       F.col("low").alias("previous_low"), F.col("volume").alias("prev_volume"))


def previous_day_merged(summary: DataFrame, history: DataFrame, before: Column) -> DataFrame:
    """S-03: summary-derived previous day, falling back to history per column."""
    return prefer(previous_day(summary, before), previous_day_history(history), "security_code",
                  ["previous_low", "prev_volume"])


def avg_volume_history(history: DataFrame, as_of: Column, days: int = K.HISTORY_LOOKBACK_DAYS,
                       min_days: int = K.STRICT_MIN_DAYS) -> DataFrame:
    """S-04: volume sum and day count over ``[as_of - days, ...]`` with ``min_days`` rows."""
    h = history.where(F.col("volume").isNotNull() & (F.col("trade_date") >= F.date_sub(as_of, days)))
    return (h.groupBy(F.col("code").alias("security_code"))
             .agg(F.sum(F.col("volume").cast("decimal(20,0)")).alias("vol_sum"),
                  F.count(F.lit(1)).alias("vol_days"))
             .where(F.col("vol_days") >= min_days))


def avg_volume_daily(daily: DataFrame, before: Column, min_days: int = K.SUMMARY_MIN_DAYS) -> DataFrame:
    """S-05: volume sum over end-of-day rows before ``before``, at least ``min_days`` days."""
    d = daily.where(F.col("data_date") < before)
    return (d.groupBy("security_code")
             .agg(F.sum(F.col("trade_volume").cast("decimal(20,0)")).alias("vol_sum"),
                  F.count_distinct("data_date").alias("vol_days"))
             .where(F.col("vol_days") >= min_days))


def day_stats(daily: DataFrame, before: Column, min_days: int = 0) -> DataFrame:
    """Previous day (S-01 at day grain) and range statistics (S-05/S-06) in ONE grouped
    pass over end-of-day rows before ``before``.

    End-of-day rows are unique per (symbol, date), so the previous day is
    ``max_by(..., data_date)`` and ``COUNT(DISTINCT data_date)`` is a plain count; the
    statistics are NULL (not the row dropped) when fewer than ``min_days`` days exist,
    exactly as the separate left-joined subqueries behave.
    """
    d = daily.where(F.col("data_date") < before)
    g = d.groupBy("security_code").agg(
        F.max_by("lowest_price", "data_date").alias("previous_low"),
        F.max_by("trade_volume", "data_date").alias("prev_volume"),
        F.sum(F.col("trade_volume").cast("decimal(20,0)")).alias("vol_sum"),
        F.max("close_price").alias("max_price_20d"),
        F.min("close_price").alias("min_price_20d"),
        F.count(F.lit(1)).alias("vol_days"))
    if min_days > 0:
        ok = F.col("vol_days") >= min_days
        g = g.withColumns({c: F.when(ok, F.col(c)) for c in
                           ("vol_sum", "max_price_20d", "min_price_20d", "vol_days")})
    return g


def range_stats(daily: DataFrame, before: Column, min_days: int = 0) -> DataFrame:
    """S-06: volume sum, max/min close and day count over end-of-day rows before ``before``."""
    d = daily.where(F.col("data_date") < before)
    return (d.groupBy("security_code")
             .agg(F.sum(F.col("trade_volume").cast("decimal(20,0)")).alias("vol_sum"),
                  F.max("close_price").alias("max_price_20d"),
                  F.min("close_price").alias("min_price_20d"),
                  F.count_distinct("data_date").alias("vol_days"))
             .where(F.col("vol_days") >= min_days))


def with_rebound_criteria(df: DataFrame, *, min_value=K.LIQUID_VALUE, down=K.DOWN_FROM_OPEN, shadow=K.LOWER_SHADOW,
                          surge=K.VOLUME_SURGE, support=K.NEAR_SUPPORT, with_3b: bool = False) -> DataFrame:
    """Candle metrics plus the five rebound flags over a joined per-symbol frame."""
    out = df.withColumns({
        "price_to_open_ratio": C.price_to_open_ratio(),
        "is_down_from_open": C.down_from_open(f=down),
        "candle_range": C.candle_range(),
        "lower_shadow": C.lower_shadow(),
        "lower_shadow_ratio": C.lower_shadow_ratio(),
        "has_long_lower_shadow": C.long_lower_shadow(f=shadow),
        "volume_to_avg_ratio": ratio(F.col("trade_volume"), C.avg_double()),
        "has_volume_surge": C.volume_surge(f=surge),
        "is_liquid": C.liquid(min_value=min_value),
        "low_to_prev_low_ratio": ratio("lowest_price", "previous_low"),
        "is_near_support": C.near_support(f=support),
    })
    if with_3b:
        out = out.withColumn("volume_below_avg", C.volume_below_avg())
    return out.withColumn("criteria_met", score(*REBOUND_FLAGS))


# --- screens ------------------------------------------------------------------------------

def momentum_rebound_strict(summary: DataFrame, history: DataFrame, as_of=None, history_as_of=None,
                            *, min_criteria: int = 5, min_value=K.LIQUID_VALUE, min_days: int = K.STRICT_MIN_DAYS,
                            lookback_days: int = K.HISTORY_LOOKBACK_DAYS, **factors) -> DataFrame:
    """S-14 / S-15: all five criteria (or at least ``min_criteria``), inner joins.

    ``as_of`` (default ``CURRENT_DATE``) picks the snapshot day; ``history_as_of``
    (default: the same day) anchors the 30-calendar-day volume average.
    """
    today = as_of_text(as_of)
    hist_day = text_day(today) if history_as_of is None else (
        history_as_of if isinstance(history_as_of, Column) else F.to_date(F.lit(str(history_as_of))))
    prev = previous_day_merged(summary, history, today)
    av = avg_volume_history(history, hist_day, lookback_days, min_days)
    ls = latest_snapshot(summary, today).withColumnRenamed("close_price", "current_price")
    j = ls.join(prev, "security_code").join(av, "security_code")
    c = with_rebound_criteria(j, min_value=min_value, **factors)
    if min_criteria >= 5:
        c = c.where(F.col("is_down_from_open") & F.col("has_long_lower_shadow") & F.col("has_volume_surge")
                    & F.col("is_liquid") & F.col("is_near_support"))
        order = [F.col("trade_value").desc(), F.col("volume_to_avg_ratio").desc_nulls_first()]
    else:
        c = c.where(F.col("criteria_met") >= min_criteria)
        order = [F.col("criteria_met").desc(), F.col("trade_value").desc(),
                 F.col("volume_to_avg_ratio").desc_nulls_first()]
    return c.select(
        "security_code", "current_price", "opening_price", "highest_price", "lowest_price", "previous_low",
        F.col("data_time").alias("latest_time"), F.col("trade_volume").alias("today_volume"),
        F.col("trade_value").alias("today_value"), C.avg_double().alias("avg_volume_20d"),
        "price_to_open_ratio", "lower_shadow_ratio", "volume_to_avg_ratio", "low_to_prev_low_ratio",
        "candle_range", "lower_shadow",
        F.col("is_down_from_open").alias("✓_down_3pct"), F.col("has_long_lower_shadow").alias("✓_long_shadow"),
        F.col("has_volume_surge").alias("✓_volume_surge"), F.col("is_liquid").alias("✓_liquid"),
        F.col("is_near_support").alias("✓_near_support"), F.col("criteria_met").alias("criteria_met_count"),
    ).orderBy(*order, "security_code")


def momentum_rebound_detail(summary: DataFrame, history: DataFrame | None = None, *,
                            min_value=K.LIQUID_VALUE, with_3b: bool = False, min_days: int | None = None,
                            lookback_days: int = K.HISTORY_LOOKBACK_DAYS, **factors) -> DataFrame:
    """S-16 (summary + history), S-17 (``history=None``), S-18 (``with_3b=True``).

    Left joins: a symbol without previous day or average keeps its row with false
    flags. Rows with a long lower shadow and liquidity are shown, best score first.
    """
    today = max_data_date(summary)
    if history is not None:
        prev = previous_day_merged(summary, history, today)
        hist_day = history.select(F.max("trade_date")).scalar()
        av = avg_volume_history(history, hist_day, lookback_days, K.DETAIL_MIN_DAYS if min_days is None else min_days)
    else:
        daily = eod_snapshots(summary, require=["lowest_price", "trade_volume", "close_price"])
        stats = day_stats(daily, today, K.SUMMARY_MIN_DAYS if min_days is None else min_days)
    ls = latest_snapshot(summary, today).withColumnRenamed("close_price", "current_price")
    if history is not None:
        j = ls.join(prev, "security_code", "left").join(av, "security_code", "left")
    else:
        j = ls.join(stats.drop("max_price_20d", "min_price_20d"), "security_code", "left")
    c = with_rebound_criteria(j, min_value=min_value, with_3b=with_3b, **factors)
    c = c.where(F.col("has_long_lower_shadow") & F.col("is_liquid"))
    marks = [mark("is_down_from_open").alias("1_Down3%"), mark("has_long_lower_shadow").alias("2_LongShadow"),
             mark("has_volume_surge").alias("3_VolSurge")]
    if with_3b:
        marks.append(mark("volume_below_avg").alias("3b_VolBelowAvg"))
    marks += [mark("is_liquid").alias("4_Liquid"), mark("is_near_support").alias("5_NearSupport")]
    return c.select(
        "security_code", "data_date", "data_time", "current_price", "opening_price", "highest_price",
        "lowest_price", "previous_low", F.col("trade_volume").alias("today_volume"),
        F.col("trade_value").alias("today_value"), C.avg_rounded().alias("avg_volume_20d"),
        F.col("vol_days").cast("double").alias("avg_days_count"),
        "price_to_open_ratio", "lower_shadow_ratio", "volume_to_avg_ratio", "low_to_prev_low_ratio",
        "candle_range", "lower_shadow", *marks, "criteria_met",
    ).orderBy(F.col("criteria_met").desc(), F.col("today_value").desc(), "security_code")


# --- diagnostics over the latest snapshot ----------------------------------------------------

def criteria_counts(summary: DataFrame, *, min_value=K.LIQUID_VALUE, down=K.DOWN_FROM_OPEN, shadow=K.LOWER_SHADOW) -> DataFrame:
    """K-06: how many latest-date symbols meet each relaxed criterion.

    The latest row per symbol is taken over all time (Q21) and then restricted to
    the latest date.
    """
    ls = latest_snapshot(summary)
    ls = ls.where(F.col("data_date") == max_data_date(summary))
    one = F.lit(1)
    return ls.agg(
        F.count(F.lit(1)).alias("total_stocks"),
        F.sum(F.when(C.down_from_open("close_price", f=down), one).otherwise(0)).cast("bigint").alias("down_3pct_count"),
        F.sum(F.when(C.long_lower_shadow("close_price", f=shadow), one).otherwise(0)).cast("bigint").alias("long_shadow_count"),
        F.sum(F.when(C.liquid(min_value=min_value), one).otherwise(0)).cast("bigint").alias("liquid_count"),
    )


def rebound_candidates(summary: DataFrame, n: int = K.CANDIDATE_LIST_SIZE, *, min_value=K.LIQUID_VALUE, down=K.DOWN_FROM_OPEN,
                       shadow=K.LOWER_SHADOW) -> DataFrame:
    """K-07: latest snapshot per symbol with a long lower shadow and liquidity, top ``n``
    by traded value, with YES/NO marks."""
    ls = latest_snapshot(summary)
    shadow_ok = C.long_lower_shadow("close_price", f=shadow)
    c = ls.where((F.col("trade_value") >= F.lit(int(min_value))) & shadow_ok)
    out = c.select(
        "security_code", "opening_price", "highest_price", "lowest_price", "close_price", "trade_value",
        C.price_to_open_ratio("close_price").alias("price_to_open_ratio"),
        ratio(C.lower_shadow("close_price"), C.candle_range()).alias("lower_shadow_ratio"),
        mark(C.down_from_open("close_price", f=down), K.WORD_YES, K.WORD_NO).alias("down_3pct"),
        mark(shadow_ok, K.WORD_YES, K.WORD_NO).alias("long_shadow"),
        mark(C.liquid(min_value=min_value), K.WORD_YES, K.WORD_NO).alias("liquid"),
    )
    return out.orderBy(F.col("trade_value").desc(), "security_code").limit(n)


def rebound_backtest(summary: DataFrame, *, min_criteria: int = 5, min_days: int = K.SUMMARY_MIN_DAYS,
                     min_value=K.LIQUID_VALUE, **factors) -> DataFrame:
    """The summary-only rebound screen (S-17) evaluated for every date at once (§7.3).

    Each end-of-day row is that day's latest snapshot; the previous day is ``lag``
    over the end-of-day rows; the volume average runs over all earlier days of the
    symbol (at least ``min_days``). One sort per symbol, no per-date loop.
    """
    from pyspark.sql import Window
    daily = eod_snapshots(summary, require=["lowest_price", "trade_volume", "close_price"])
    w = Window.partitionBy("security_code").orderBy("data_date")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    d = daily.withColumns({
        "previous_low": F.lag("lowest_price").over(w),
        "prev_volume": F.lag("trade_volume").over(w),
        "vol_sum": F.sum(F.col("trade_volume").cast("decimal(20,0)")).over(before),
        "vol_days": F.count("data_date").over(before),
    })
    d = d.withColumns({
        "vol_sum": F.when(F.col("vol_days") >= min_days, F.col("vol_sum")),
        "vol_days": F.when(F.col("vol_days") >= min_days, F.col("vol_days")),
    }).withColumnRenamed("close_price", "current_price")
    c = with_rebound_criteria(d, min_value=min_value, **factors).where(F.col("criteria_met") >= min_criteria)
    return c.select(
        "security_code", "data_date", "current_price", "opening_price", "highest_price", "lowest_price",
        "previous_low", F.col("trade_volume").alias("today_volume"), F.col("trade_value").alias("today_value"),
        C.avg_rounded().alias("avg_volume_20d"), "price_to_open_ratio", "lower_shadow_ratio",
        "volume_to_avg_ratio", "low_to_prev_low_ratio", *REBOUND_FLAGS, "criteria_met",
    ).orderBy(F.col("data_date").desc(), F.col("criteria_met").desc(), F.col("today_value").desc(),
              "security_code")
