"""The 11-criteria as-of-date momentum screen with trade-tape data (S-27).

Dataflow: end-of-day snapshots of the ``window_days`` before the as-of day (board
and date pruned at the scan) feed the previous-day row and the range statistics;
the as-of day's latest snapshot is joined with them and with the tape summary of
that day's trades (semi-joined to the symbols in the snapshot). All joins are
between one-row-per-symbol frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bursa import constants as K

from bursa.functions.expr import mark, pct_change, ratio, round_half_away, score
from bursa.operators import candle as C
from bursa.operators.latest import eod_snapshots, latest_snapshot
from bursa.operators.tape import tick_direction, trade_tape_summary, trades_on
from bursa.plans.rebound import day_stats, with_rebound_criteria

ASOF_FLAGS = ["is_down_from_open", "has_long_lower_shadow", "has_volume_surge", "is_liquid", "is_near_support",
              "has_trade_flow_momentum", "has_aggressive_buying", "volume_not_overheated",
              "price_strengthening", "not_overextended", "not_in_downtrend"]


def _pct_of(diff: Column, base: Column) -> Column:
    return round_half_away(diff.cast("double") / F.nullif(base.cast("double"), F.lit(0.0)) * F.lit(100.0), 2)


def momentum_rebound_asof(summary: DataFrame, trades: DataFrame, as_of, *, board: str | None = "RG",
                          window_days: int = K.RANGE_WINDOW_DAYS, min_days: int = 0, min_trades: int = K.MIN_TAPE_TRADES,
                          large_volume: int = K.LARGE_TRADE_VOLUME, min_value=K.LIQUID_VALUE, momentum_pct=K.TAPE_MOMENTUM_PCT,
                          buy_share=K.AGGRESSIVE_BUY_SHARE, overheated=K.NOT_OVERHEATED, strengthening=K.STRENGTHENING, extended=K.NOT_OVEREXTENDED,
                          downtrend=K.NOT_IN_DOWNTREND, slice_minutes: int = 5, **factors) -> DataFrame:
    """S-27 for one ``as_of`` date (a ``datetime.date``, ``'yyyy-mm-dd'`` text or a
    DATE column such as a scalar subquery)."""
    day = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    day_txt = F.date_format(day, "yyyyMMdd")
    lo_txt = F.date_format(F.date_sub(day, window_days), "yyyyMMdd")

    ds = eod_snapshots(summary, board=board, lo=lo_txt, hi=day_txt,
                       require=["lowest_price", "trade_volume", "close_price"])
    stats = day_stats(ds, day_txt, min_days)
    ls = latest_snapshot(summary, day_txt, board=board).withColumnRenamed("close_price", "current_price")

    t = trades_on(trades, day).join(ls.select("security_code"), "security_code", "left_semi")
    tape = trade_tape_summary(tick_direction(t, slice_minutes), min_trades=min_trades,
                              large_volume=large_volume).drop("trade_day")
    tape = tape.select("security_code", *[F.col(c).alias(f"tma_{c}") for c in tape.columns if c != "security_code"])

    j = ls.join(stats, "security_code", "left").join(tape, "security_code", "left")
    return _screen_output(j, min_value=min_value, momentum_pct=momentum_pct, buy_share=buy_share,
                          overheated=overheated, strengthening=strengthening, extended=extended,
                          downtrend=downtrend, **factors).orderBy(
        F.col("total_criteria_met").desc(), F.col("today_value").desc(), "security_code")


def _screen_output(j: DataFrame, *, min_value, momentum_pct, buy_share, overheated, strengthening, extended,
                   downtrend, **factors) -> DataFrame:
    """Flags, score and the output columns of the as-of screen over a joined frame."""
    c = with_rebound_criteria(j, min_value=min_value, with_3b=True, **factors)
    c = c.withColumns({
        "has_trade_flow_momentum": C.trade_flow_momentum("tma_trade_price_momentum_pct", momentum_pct),
        "has_aggressive_buying": C.aggressive_buying("tma_aggressive_buy_volume", "tma_total_trade_volume",
                                                     buy_share),
        "volume_not_overheated": C.not_overheated(f=overheated),
        "price_strengthening": C.price_strengthening(f=strengthening),
        "not_overextended": C.not_overextended(f=extended),
        "not_in_downtrend": C.not_in_downtrend(f=downtrend),
    }).withColumn("total_criteria_met", score(*ASOF_FLAGS))
    c = c.where(F.col("has_long_lower_shadow") & F.col("is_liquid"))
    z = F.lit(0)
    return c.select(
        "security_code", "data_date", "data_time", "current_price", "opening_price", "highest_price",
        "lowest_price", "previous_low", "previous_price",
        F.col("trade_volume").alias("today_volume"), F.col("trade_value").alias("today_value"),
        C.avg_rounded().alias("avg_volume_20d"), F.col("vol_days").cast("double").alias("avg_days_count"),
        F.coalesce("tma_total_trade_count", z.cast("bigint")).alias("total_trade_count"),
        F.coalesce("tma_total_trade_volume", z.cast("bigint")).alias("trade_executed_volume"),
        F.coalesce("tma_trades_per_hour", F.lit(0.0)).alias("trades_per_hour"),
        F.coalesce("tma_trade_price_momentum_pct", F.lit(0.0)).alias("trade_price_momentum_pct"),
        F.coalesce(F.col("tma_vwap_price"), F.col("current_price").cast("double")).alias("vwap_price"),
        F.coalesce("tma_aggressive_buy_volume", z.cast("bigint")).alias("aggressive_buy_volume"),
        F.coalesce("tma_price_direction_score", z.cast("bigint")).alias("price_direction_score"),
        F.coalesce("tma_large_trade_volume", z.cast("bigint")).alias("large_trade_volume"),
        "price_to_open_ratio", "lower_shadow_ratio", "volume_to_avg_ratio", "low_to_prev_low_ratio",
        pct_change("current_price", "previous_price").alias("price_change_pct"),
        pct_change("current_price", "min_price_20d").alias("price_increase_20d_pct"),
        _pct_of(F.col("max_price_20d") - F.col("current_price"), F.col("max_price_20d"))
        .alias("price_decrease_from_high_pct"),
        "max_price_20d", "min_price_20d", "candle_range", "lower_shadow",
        mark("is_down_from_open").alias("1_Down3%"), mark("has_long_lower_shadow").alias("2_LongShadow"),
        mark("has_volume_surge").alias("3_VolSurge"), mark("volume_below_avg").alias("3b_VolBelowAvg"),
        mark("is_liquid").alias("4_Liquid"), mark("is_near_support").alias("5_NearSupport"),
        mark("has_trade_flow_momentum").alias("6_TradeMomentum"),
        mark("has_aggressive_buying").alias("7_AggressiveBuy"),
        mark("volume_not_overheated").alias("8_NotOverheated"), mark("price_strengthening").alias("9_Price>3%"),
        mark("not_overextended").alias("11_NotExtended<10%"), mark("not_in_downtrend").alias("12_NotDown>5%"),
        "total_criteria_met",
    )


def momentum_rebound_backtest(summary: DataFrame, trades: DataFrame, *, board: str | None = "RG",
                              window_days: int = K.RANGE_WINDOW_DAYS, min_days: int = 0, min_trades: int = K.MIN_TAPE_TRADES,
                              large_volume: int = K.LARGE_TRADE_VOLUME, min_value=K.LIQUID_VALUE, momentum_pct=K.TAPE_MOMENTUM_PCT,
                              buy_share=K.AGGRESSIVE_BUY_SHARE, overheated=K.NOT_OVERHEATED, strengthening=K.STRENGTHENING, extended=K.NOT_OVEREXTENDED,
                              downtrend=K.NOT_IN_DOWNTREND, slice_minutes: int = 5, **factors) -> DataFrame:
    """S-27 for every date at once (§7.3): same columns as ``momentum_rebound_asof`` plus
    the screened day in ``data_date``.

    * previous day = ``lag`` over the end-of-day rows, NULL when it lies before the
      ``window_days`` input window of the single-date screen;
    * range statistics = calendar ``RANGE [window_days, 1] PRECEDING`` frame;
    * tape = trades grouped by (symbol, day).
    The price/volume columns are NOT NULL in the table schema, so the end-of-day row
    of a day is also that day's latest snapshot.
    """
    from pyspark.sql import Window
    eod = eod_snapshots(summary, board=board, require=["lowest_price", "trade_volume", "close_price"])
    eod = eod.withColumn("__day", F.to_date("data_date", "yyyyMMdd"))
    w = Window.partitionBy("security_code").orderBy("__day")
    frame = Window.partitionBy("security_code").orderBy(F.unix_date("__day")).rangeBetween(-window_days, -1)
    prev_day = F.lag("__day").over(w)
    in_window = prev_day >= F.date_sub(F.col("__day"), window_days)
    d = eod.withColumns({
        "previous_low": F.when(in_window, F.lag("lowest_price").over(w)),
        "prev_volume": F.when(in_window, F.lag("trade_volume").over(w)),
        "vol_sum": F.sum(F.col("trade_volume").cast("decimal(20,0)")).over(frame),
        "max_price_20d": F.max("close_price").over(frame),
        "min_price_20d": F.min("close_price").over(frame),
        "vol_days": F.count("data_date").over(frame),
    })
    if min_days > 0:
        ok = F.col("vol_days") >= min_days
        d = d.withColumns({c: F.when(ok, F.col(c)) for c in ("vol_sum", "max_price_20d", "min_price_20d",
                                                               "vol_days")})
    d = d.withColumns({c: F.when(F.col("vol_days") > 0, F.col(c)) for c in
                       ("vol_sum", "max_price_20d", "min_price_20d", "vol_days")})
    tape = trade_tape_summary(tick_direction(trades, slice_minutes), min_trades=min_trades, large_volume=large_volume)
    tape = tape.select("security_code", F.col("trade_day").alias("__day"),
                       *[F.col(c).alias(f"tma_{c}") for c in tape.columns if c not in ("security_code", "trade_day")])
    j = d.withColumnRenamed("close_price", "current_price").join(tape, ["security_code", "__day"], "left")
    return _screen_output(j, min_value=min_value, momentum_pct=momentum_pct, buy_share=buy_share,
                          overheated=overheated, strengthening=strengthening, extended=extended,
                          downtrend=downtrend, **factors).orderBy(
        F.col("data_date").desc(), F.col("total_criteria_met").desc(), F.col("today_value").desc(),
        "security_code")
