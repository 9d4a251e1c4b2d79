"""Sideways screens and the nightly sideways state (S-36..S-40).

Day bars come from one grouped pass over the snapshots (``min_by``/``max_by`` are
fixed-width aggregates, so they combine map-side). The rolling frames are calendar
``RANGE`` frames over one symbol's bars. Ratios are shown as doubles; the screen
conditions are evaluated exactly on the frame sums and counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bursa import constants as K

from bursa.functions.expr import dec, flag

_DAY_US = 86_400_000_000


def daily_bars(summary: DataFrame, volume_mode: str = "sum") -> DataFrame:
    """S-36: per symbol and ``date(ts)``: first open, max high, min low, last close,
    and the volume/value as the sum of the snapshots (Q2, reference) or the last one."""
    if volume_mode == "sum":
        vol = F.sum(F.col("trade_volume").cast("decimal(30,0)"))
        val = F.sum(F.col("trade_value").cast("decimal(30,0)"))
    elif volume_mode == "last":
        vol = F.max_by(F.col("trade_volume").cast("decimal(30,0)"), "ts")
        val = F.max_by(F.col("trade_value").cast("decimal(30,0)"), "ts")
    else:
        raise ValueError(f"volume_mode must be 'sum' or 'last', not {volume_mode!r}")
    return summary.groupBy("security_code", F.to_date("ts").alias("trade_date")).agg(
        F.min_by("opening_price", "ts").alias("open"), F.max("highest_price").alias("high"),
        F.min("lowest_price").alias("low"), F.max_by("close_price", "ts").alias("close"),
        vol.alias("volume"), val.alias("value"))


def build_daily_ohlc(summary: DataFrame) -> DataFrame:
    """A-07: the ``daily_ohlc`` table from the snapshots: one bar per symbol and day,
    volume and value taken from the day's last (cumulative) snapshot."""
    b = daily_bars(summary, volume_mode="last")
    return b.select(F.col("trade_date").cast("timestamp_ntz").alias("bucket"), "security_code", "open", "high",
                    "low", "close", F.col("volume").cast("bigint").alias("volume"),
                    F.col("value").cast("bigint").alias("value"))


def _rolling(df: DataFrame, w) -> DataFrame:
    return df.withColumns({
        "max_close_prev": F.max("close").over(w), "min_close_prev": F.min("close").over(w),
        "__vsum": F.sum(F.col("volume").cast("decimal(30,0)")).over(w), "__vn": F.count("volume").over(w),
        "__asum": F.sum(F.col("value").cast("decimal(30,0)")).over(w), "__an": F.count("value").over(w),
    })


def _as_of_date(as_of):
    if as_of is None or isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def sideways_screen(bars: DataFrame, days: int = K.SIDEWAYS_DAYS_SHORT, *, max_range=K.SIDEWAYS_RANGE,
                    max_volume=K.SIDEWAYS_VOLUME, min_avg_value=K.SIDEWAYS_VALUE_7D, last_day_only: bool = True,
                    as_of=None) -> DataFrame:
    """S-37: narrow prior range, falling volume, liquid — on the last day (or every day).

    Frame: ``RANGE BETWEEN days PRECEDING AND 1 DAY PRECEDING``; a symbol without
    prior rows is dropped (Q22). ``as_of`` (a date) evaluates a past night: the bars
    are restricted to ``trade_date <= as_of`` (the one-row theta join, C-06) before
    the last day is taken.
    """
    w = Window.partitionBy("security_code").orderBy(F.unix_date("trade_date")).rangeBetween(-days, -1)
    as_of = _as_of_date(as_of)
    if as_of is not None:
        bars = bars.where(F.col("trade_date") <= as_of)
    if last_day_only:
        # only bars within the frame of the last day matter: cut the input before the window
        # (Catalyst cannot move a filter below a window on a non-partition column)
        last = bars.select(F.max("trade_date")).scalar()
        r = _rolling(bars.where(F.col("trade_date") >= F.date_sub(last, days)), w)
        r = r.where(F.col("trade_date") == last)
    else:
        r = _rolling(bars, w)
    rng = F.col("max_close_prev") - F.col("min_close_prev")
    cond = ((F.col("min_close_prev") != 0) & (rng < dec(max_range) * F.col("min_close_prev"))
            & (F.col("__vsum") != 0) & (F.col("volume") * F.col("__vn") < dec(max_volume) * F.col("__vsum"))
            & (F.col("__an") > 0) & (F.col("__asum") > F.lit(int(min_avg_value)) * F.col("__an")))
    out = r.where(cond).select(
        F.col("security_code").alias("symbol"), "trade_date",
        (rng.cast("double") / F.col("min_close_prev").cast("double")).alias("range_ratio"),
        (F.col("volume").cast("double") / (F.col("__vsum").cast("double") / F.col("__vn").cast("double")))
        .alias("volume_ratio"),
        (F.col("__asum").cast("double") / F.col("__an").cast("double")).alias("avg_value_prev"),
    )
    return out.orderBy("range_ratio", "symbol", "trade_date")


def sideways_from_summary(summary: DataFrame, days: int = K.SIDEWAYS_DAYS_SHORT, *, as_of=None, **params) -> DataFrame:
    """S-37 for the last day straight from the snapshots: only the partitions of the days
    in the last day's frame are read. ``data_date`` is within a day of ``ts``, by which
    bars are dated, so its bounds leave a day on either side."""
    as_of = _as_of_date(as_of)
    if as_of is not None:
        summary = summary.where(F.col("data_date") <= F.date_format(F.date_add(as_of, 1), "yyyyMMdd"))
        summary = summary.where(F.to_date("ts") <= as_of)
    newest = summary.select(F.max("data_date")).scalar()
    near = summary.where(F.col("data_date") >= F.date_format(F.date_sub(F.to_date(newest, "yyyyMMdd"), 2), "yyyyMMdd"))
    last = near.select(F.to_date(F.max("ts"))).scalar()
    lo = F.date_sub(last, days)
    s = summary.where((F.col("data_date") >= F.date_format(F.date_sub(lo, 1), "yyyyMMdd"))
                      & (F.col("ts") >= lo.cast("timestamp_ntz")))
    return sideways_screen(daily_bars(s), days, last_day_only=True, **params)


def sideways_state(daily_ohlc: DataFrame, days: int = K.SIDEWAYS_DAYS_NIGHTLY, *, max_range=K.SIDEWAYS_RANGE,
                   max_volume=K.SIDEWAYS_VOLUME, min_avg_value=K.SIDEWAYS_VALUE_NIGHTLY, last_day_only: bool = True,
                   as_of=None, renewed: str | None = None) -> DataFrame:
    """S-38: the nightly sideways state of every symbol trading on the last day
    (``last_day_only=False`` back-fills every day). No prior rows gives ratios 0 and
    ``is_sideways = false`` (Q22). ``as_of`` re-runs a past night: bars after it are
    excluded (``bucket::date <= as_of``, the one-row theta join C-06). ``renewed`` names a
    column that is true in rows without values: they mark bars that came, and only the days
    within ``days`` behind such a bar are given."""
    as_of = _as_of_date(as_of)
    if as_of is not None:
        daily_ohlc = daily_ohlc.where(F.col("bucket") < F.date_add(as_of, 1).cast("timestamp_ntz"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    pos = F.timestamp_diff("MICROSECOND", epoch, F.col("bucket"))
    w = (Window.partitionBy("security_code").orderBy(pos)
         .rangeBetween(-days * _DAY_US, -_DAY_US))
    bars = daily_ohlc
    if last_day_only:
        # the last day's frame reaches back ``days`` days: read only that much history
        last_bucket = daily_ohlc.select(F.max("bucket")).scalar()
        bars = bars.where(F.col("bucket") >= last_bucket - F.expr(f"INTERVAL {days} DAYS"))
    r = _rolling(bars.withColumn("trade_date", F.to_date("bucket")), w)
    if last_day_only:
        r = r.where(F.col("trade_date") == daily_ohlc.select(F.to_date(F.max("bucket"))).scalar())
    if renewed is not None:
        near = Window.partitionBy("security_code").orderBy(F.unix_date("trade_date")).rangeBetween(-days, 0)
        r = r.withColumn("__near", F.max(renewed).over(near)).where(F.col("__near") & ~F.col(renewed))
    mn, mx = F.col("min_close_prev"), F.col("max_close_prev")
    vsum, vn = F.col("__vsum"), F.col("__vn")
    has_range = mn > 0
    has_volume = vsum > 0
    range_ratio = F.when(has_range, (mx - mn).cast("double") / mn.cast("double")).otherwise(F.lit(0.0))
    volume_ratio = F.when(has_volume, F.col("volume").cast("double") / (vsum.cast("double") / vn.cast("double"))
                          ).otherwise(F.lit(0.0))
    range_ok = F.when(has_range, (mx - mn) < dec(max_range) * mn).otherwise(F.lit(0 < max_range))
    volume_ok = F.when(has_volume, F.col("volume") * vn < dec(max_volume) * vsum).otherwise(F.lit(0 < max_volume))
    value_ok = F.when(F.col("__an") > 0, F.col("__asum") > F.lit(int(min_avg_value)) * F.col("__an"))
    return r.select(
        F.col("security_code").alias("symbol"), "trade_date", range_ratio.alias("range_ratio"),
        volume_ratio.alias("volume_ratio"), flag(range_ok & volume_ok & value_ok).alias("is_sideways"))


def current_sideways(state: DataFrame) -> DataFrame:
    """S-40: sideways symbols of the latest stored day, tightest range first."""
    latest = state.select(F.max("trade_date")).scalar()
    return (state.where((F.col("trade_date") == latest) & F.col("is_sideways"))
                 .orderBy("range_ratio", "symbol"))


def store_sideways(state: DataFrame, path: str) -> None:
    """S-39: upsert the state rows on ``(symbol, trade_date)`` (A-21).

    The table is partitioned by ``trade_month`` (derived from the key), so a nightly
    run rewrites one month of state, not one directory per day.
    """
    from bursa.sources.sinks import upsert
    rows = state.withColumn("trade_month", F.date_format("trade_date", "yyyy-MM"))
    upsert(rows, path, keys=["symbol", "trade_date"], partition_by=["trade_month"])


def read_sideways(spark, path: str) -> DataFrame:
    """Read the stored state with its declared columns."""
    from bursa.sources.schemas import SIDEWAYS_STATE
    return spark.read.parquet(path).select(*[f.name for f in SIDEWAYS_STATE.fields])
