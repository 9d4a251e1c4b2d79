"""Day-cumulative snapshots from trades (the ``stock_summary`` semantics, §1.3).

After every trade the snapshot carries the day's open, running high/low, last
price and running volume, value and trade count. A plain running window over
(symbol, day) puts a hot symbol-day into one task, so the totals are built in two
levels, exactly:

1. running aggregates inside (symbol, day, time slice) — many small partitions, a burst
   cut at its own quantiles (``slices.py``);
2. per slice totals (one row per slice, hash-aggregated), turned into "everything
   before this slice" prefixes by a window over the slices of a symbol-day (their number
   is bounded), joined back and combined with the in-slice running values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bursa.operators.slices import HOT_ROWS, with_slices


def day_cumulative(trades: DataFrame, slice_minutes: int = 5, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``opening_price``, ``highest_price``, ``lowest_price``, ``trade_volume``,
    ``trade_value`` (rounded) and ``trade_frequency`` running over each symbol's
    ``trade_date``, ordered by ``(ts, trade_no)``."""
    trades, slices = with_slices(trades, ["security_code", "trade_date"], minutes=slice_minutes, hot_rows=hot_rows)
    # traded value in integer cents: exact long arithmetic on the per-trade hot path
    t = trades.withColumn("__pv", (F.col("price") * 100).cast("bigint") * F.col("volume"))
    keys = ["security_code", "trade_date", *slices]
    w = (Window.partitionBy(*keys).orderBy("ts", "trade_no")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    t = t.withColumns({
        "__first": F.first("price").over(w), "__hi": F.max("price").over(w), "__lo": F.min("price").over(w),
        "__v": F.sum("volume").over(w), "__pvs": F.sum("__pv").over(w), "__n": F.count(F.lit(1)).over(w),
    })
    per_slice = t.groupBy(*keys).agg(
        F.max("__first").alias("__s_first"), F.max("price").alias("__s_hi"), F.min("price").alias("__s_lo"),
        F.sum("volume").alias("__s_v"), F.sum("__pv").alias("__s_pv"), F.count(F.lit(1)).alias("__s_n"))
    day = Window.partitionBy("security_code", "trade_date").orderBy(*slices)
    before = day.rowsBetween(Window.unboundedPreceding, -1)
    prefix = per_slice.select(
        *keys,
        F.first("__s_first").over(day.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("__day_open"),
        F.max("__s_hi").over(before).alias("__p_hi"), F.min("__s_lo").over(before).alias("__p_lo"),
        F.sum("__s_v").over(before).alias("__p_v"), F.sum("__s_pv").over(before).alias("__p_pv"),
        F.sum("__s_n").over(before).alias("__p_n"))
    j = t.join(prefix, keys)
    z = F.lit(0)
    out = j.withColumns({
        "opening_price": F.col("__day_open"),
        "highest_price": F.greatest("__p_hi", "__hi"),
        "lowest_price": F.least("__p_lo", "__lo"),
        "trade_volume": (F.coalesce("__p_v", z) + F.col("__v")).cast("bigint"),
        # cents -> rupiah, rounded half up (values are non-negative)
        "trade_value": F.floor((F.coalesce("__p_pv", z) + F.col("__pvs") + F.lit(50)) / F.lit(100)).cast("bigint"),
        "trade_frequency": (F.coalesce("__p_n", z) + F.col("__n")).cast("bigint"),
    })
    return out.drop(*[c for c in out.columns if c.startswith("__")])
