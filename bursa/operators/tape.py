"""Trade-tape analytics: tick direction (S-19) and the per symbol-day tape summary (S-20).

Tick direction needs the previous trade of the same symbol and day. A plain
``LAG`` over ``(symbol, day)`` puts a hot symbol-day into one task, so the lag is
taken in two levels, exactly:

1. ``LAG`` inside (symbol, day, time slice) — many small window partitions, a burst cut
   at its own quantiles (``slices.py``);
2. the first trade of a slice takes the last price of the previous non-empty slice,
   found by a ``LAG`` over the per-slice last prices (one row per slice).

The summary is a plain grouped aggregate with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bursa import constants as K

from bursa.functions.expr import flag, round_half_away, seconds_between
from bursa.operators.slices import HOT_ROWS, with_slices


def tick_direction(trades: DataFrame, slice_minutes: int = 5, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``trade_day``, ``prev_price``, ``is_price_up`` and ``is_price_down`` per trade.

    Trades are ordered by ``(ts, trade_no)`` within symbol and calendar day of ``ts``
    (Q4: ``trade_no`` breaks ties between same-instant trades).
    """
    t, slices = with_slices(trades.withColumn("trade_day", F.to_date("ts")), ["security_code", "trade_day"],
                            minutes=slice_minutes, hot_rows=hot_rows)
    keys = ["security_code", "trade_day", *slices]
    w = Window.partitionBy(*keys).orderBy("ts", "trade_no")
    t = t.withColumns({"__prev_in_slice": F.lag("price").over(w),
                       "__is_last": F.lead("trade_no").over(w).isNull()})
    last = t.where(F.col("__is_last")).select(*keys, F.col("price").alias("__last_price"))
    carry = last.select(*keys, F.lag("__last_price").over(
        Window.partitionBy("security_code", "trade_day").orderBy(*slices)).alias("__prev_slice_price"))
    j = t.join(carry, keys, "left")
    prev = F.coalesce(F.col("__prev_in_slice"), F.col("__prev_slice_price"))
    return (j.withColumns({"prev_price": prev,
                           "is_price_up": flag(F.col("price") > prev),
                           "is_price_down": flag(F.col("price") < prev)})
             .drop(*slices, "__prev_in_slice", "__is_last", "__prev_slice_price"))


def trade_tape_summary(ticks: DataFrame, *, min_trades: int = K.MIN_TAPE_TRADES, large_volume: int = K.LARGE_TRADE_VOLUME) -> DataFrame:
    """Per symbol and day: range %, trade count, VWAP, up-tick volume, total volume,
    trades per hour, direction score and large-trade volume; ``min_trades`` trades."""
    up, down = F.col("is_price_up"), F.col("is_price_down")
    vol = F.col("volume")
    g = ticks.groupBy("security_code", "trade_day").agg(
        F.max("price").alias("__max"), F.min("price").alias("__min"),
        F.count(F.lit(1)).alias("total_trade_count"),
        # value in integer cents: long arithmetic instead of per-row BigDecimal (exact; under
        # ANSI mode, the Spark 4 default, an overflow fails the job instead of wrapping)
        F.sum((F.col("price") * 100).cast("bigint") * vol).alias("__pv_cents"), F.sum(vol).alias("total_trade_volume"),
        F.sum(F.when(up, vol).otherwise(F.lit(0))).alias("aggressive_buy_volume"),
        F.max("ts").alias("__last_ts"), F.min("ts").alias("__first_ts"),
        (F.sum(F.when(up, 1).otherwise(0)) - F.sum(F.when(down, 1).otherwise(0))).cast("bigint")
        .alias("price_direction_score"),
        F.sum(F.when(vol >= F.lit(large_volume), vol).otherwise(F.lit(0))).alias("large_trade_volume"),
    ).where(F.col("total_trade_count") >= min_trades)
    hours = seconds_between("__first_ts", "__last_ts") / F.lit(3600.0)
    return g.select(
        "security_code", "trade_day",
        round_half_away((F.col("__max") - F.col("__min")).cast("double")
                        / F.nullif(F.col("__min").cast("double"), F.lit(0.0)) * F.lit(100.0), 2)
        .alias("trade_price_momentum_pct"),
        "total_trade_count",
        round_half_away(F.col("__pv_cents").cast("double") / F.lit(100.0)
                        / F.nullif(F.col("total_trade_volume").cast("double"), F.lit(0.0)), 2).alias("vwap_price"),
        "aggressive_buy_volume", "total_trade_volume",
        round_half_away(F.col("total_trade_count").cast("double") / F.nullif(hours, F.lit(0.0)), 2)
        .alias("trades_per_hour"),
        "price_direction_score", "large_trade_volume",
    )


def trades_on(trades: DataFrame, day: Column) -> DataFrame:
    """Trades whose ``ts`` falls on ``day`` as a ``ts`` range, so the bound reaches the scan.

    ``ts`` runs up to a day away from ``trade_date``, the partition column, whose bounds
    leave three days' partitions to read.
    """
    start = day.cast("timestamp_ntz")
    near = [F.date_format(F.date_add(day, k), "yyyyMMdd") for k in (-1, 1)]
    trades = trades.where(F.col("trade_date").between(*near))
    return trades.where((F.col("ts") >= start) & (F.col("ts") < F.date_add(day, 1).cast("timestamp_ntz")))
