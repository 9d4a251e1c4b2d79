"""Trend screens: daily trading (S-28..S-32, K-10..K-12), MA5 breakout (S-33) and the
MA20 swing screen (S-34, S-35).

Moving averages are kept as exact frame sums and counts (``*_sum``/``*_n``) and
compared by cross-multiplication; the averages shown are doubles derived from them.
Windows partition by symbol and order by day, so each window partition is one
symbol's daily bars.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bursa import constants as K

from bursa.functions.expr import (cross_ge, cross_gt, cross_le, dec, guarded_ratio, mark, pct_change, ratio,
                                  round_half_away)
from bursa.operators.latest import eod_snapshots, latest_per_key, latest_snapshot, max_data_date, recent_rows
from bursa.operators.rolling import last_rows, rows_window, with_moving_sums
from bursa.operators.session import afternoon_volume_trend


# --- moving-average building blocks --------------------------------------------------------

def with_moving(df: DataFrame, col: str, n: int, name: str, by: str, order: str,
                dtype: str = "decimal(30,2)") -> DataFrame:
    """Add ``{name}_sum`` and ``{name}_n`` over the last ``n`` rows (incl. the current)."""
    return with_moving_sums(df, {name: (col, n, dtype)}, by, order)


def avg_of(name: str) -> Column:
    return guarded_ratio(f"{name}_sum", f"{name}_n")


def latest_ma5_history(history: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """S-29: MA5 of close and the last volume at each code's latest bar.

    With ``codes`` (a frame with ``security_code``) only theirs, from the last trading
    days' partitions and, for codes with gaps, older ones."""
    h = history.where(F.col("close").isNotNull() & F.col("volume").isNotNull())
    h = last_rows(h, "code", "trade_date", 5) if codes is None else recent_rows(
        h, "code", "trade_date", 5, codes.select(F.col("security_code").alias("code")))
    h = with_moving(h, "close", 5, "ma5", "code", "trade_date")
    last = latest_per_key(h, ["code"], [F.col("trade_date").desc()])
    return last.select(F.col("code").alias("security_code"), "ma5_sum", "ma5_n", "trade_date",
                       F.col("volume").alias("yesterday_volume"))


def latest_ma5_summary(summary: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """S-30 at day grain (Q3): MA5 over end-of-day closes at each symbol's latest day,
    and the volume of the trading day before it.

    With ``codes`` (a frame with ``security_code``) only theirs: six days' partitions are
    read and, for symbols that did not trade on all of them, older ones."""
    eod = lambda s: eod_snapshots(s, require=["close_price", "trade_volume"])
    d = last_rows(eod(summary), "security_code", "data_date", 6) if codes is None else recent_rows(
        summary, "security_code", "data_date", 6, codes, eod)
    d = with_moving(d, "close_price", 5, "ma5", "security_code", "data_date")
    d = d.withColumn("yesterday_volume",
                     F.lag("trade_volume").over(Window.partitionBy("security_code").orderBy("data_date")))
    last = latest_per_key(d, ["security_code"], [F.col("data_date").desc()])
    return last.select("security_code", "ma5_sum", "ma5_n", "yesterday_volume")


def daily_trading_screen(summary: DataFrame, *, min_value=K.LIQUID_VALUE, up=K.DAILY_UP, vol_up=K.DAILY_VOLUME_UP,
                         clock: str = "ts") -> DataFrame:
    """S-31: close >= MA5, >= up x previous, >= open, volume >= vol_up x last volume,
    value > min_value and a rising afternoon volume, on the latest date."""
    day = max_data_date(summary)
    ls = latest_snapshot(summary, day).withColumnRenamed("close_price", "current_price")
    ma5 = latest_ma5_summary(summary, ls)
    avt = afternoon_volume_trend(summary, day, clock=clock).select("security_code", "is_volume_increasing")
    j = ls.join(ma5, "security_code").join(avt, "security_code")
    cond = (cross_ge("current_price", 1, "ma5_sum", "ma5_n")
            & (F.col("current_price") >= dec(up) * F.col("previous_price"))
            & (F.col("current_price") >= F.col("opening_price"))
            & (F.col("trade_volume") >= dec(vol_up) * F.col("yesterday_volume"))
            & (F.col("trade_value") > F.lit(int(min_value)))
            & F.col("is_volume_increasing"))
    return j.where(cond).select(
        "security_code", "current_price", "opening_price", "previous_price", avg_of("ma5").alias("ma5"),
        "trade_volume", "trade_value", pct_change("current_price", "previous_price").alias("pct_change"),
    ).orderBy(F.col("trade_value").desc(), "security_code")


def daily_trading_marks(summary: DataFrame, history: DataFrame, n: int = K.TOP_LIST_SIZE, *,
                        min_value=K.LIQUID_VALUE, up=K.DAILY_UP, vol_up=K.DAILY_VOLUME_UP) -> DataFrame:
    """S-32: the daily-screen rules as marks for the top ``n`` symbols by value, MA5 from history."""
    day = max_data_date(summary)
    ls = latest_snapshot(summary, day).withColumnRenamed("close_price", "current_price")
    ma5 = latest_ma5_history(history, ls).drop("trade_date")
    j = ls.join(ma5, "security_code", "left")
    return j.select(
        "security_code", "data_date", "current_price", "opening_price", "previous_price",
        avg_of("ma5").alias("ma5"), F.col("trade_volume").alias("today_volume"), "yesterday_volume",
        F.col("trade_value").alias("today_value"),
        mark(cross_ge("current_price", 1, "ma5_sum", "ma5_n")).alias("above_ma5"),
        mark(F.col("current_price") >= dec(up) * F.col("previous_price")).alias("up_5pct"),
        mark(F.col("current_price") >= F.col("opening_price")).alias("green"),
        mark(F.col("trade_volume") >= dec(vol_up) * F.col("yesterday_volume")).alias("vol_up"),
        mark(F.col("trade_value") > F.lit(int(min_value))).alias("liquid"),
    ).orderBy(F.col("today_value").desc(), "security_code").limit(n)


def snapshot_counts(summary: DataFrame, *, min_value=K.LIQUID_VALUE, up=K.DAILY_UP) -> DataFrame:
    """K-11: latest-date snapshot counts: green candles, up 5 %, liquid."""
    day = max_data_date(summary)
    ls = latest_snapshot(summary, day)
    one = F.lit(1)
    return ls.agg(
        F.lit("Latest snapshot").alias("info"), F.count(one).alias("total_stocks"),
        F.max("data_date").alias("data_date"),
        F.sum(F.when(F.col("close_price") >= F.col("opening_price"), one).otherwise(0)).cast("bigint").alias("green_candles"),
        F.sum(F.when(F.col("close_price") >= dec(up) * F.col("previous_price"), one).otherwise(0)).cast("bigint").alias("up_5pct"),
        F.sum(F.when(F.col("trade_value") > F.lit(int(min_value)), one).otherwise(0)).cast("bigint").alias("liquid_stocks"),
    )


def afternoon_counts(summary: DataFrame, clock: str = "ts") -> DataFrame:
    """K-12: symbols with an afternoon trend row, and how many rise."""
    t = afternoon_volume_trend(summary, max_data_date(summary), clock=clock)
    return t.agg(F.lit("Afternoon volume trend").alias("info"), F.count(F.lit(1)).alias("total_stocks"),
                 F.sum(F.when(F.col("is_volume_increasing"), 1).otherwise(0)).cast("bigint")
                 .alias("stocks_with_increasing_volume"))


def ma_coverage(history: DataFrame, n: int = 5) -> DataFrame:
    """K-10: symbols with a full ``n``-row MA window, and the latest such day."""
    h = history.where(F.col("close").isNotNull() & F.col("volume").isNotNull())
    h = h.withColumn("days_count", F.count(F.lit(1)).over(rows_window("code", "trade_date", n)))
    return h.where(F.col("days_count") == n).agg(
        F.lit(f"MA{n} stocks with {n} days data").alias("info"),
        F.count_distinct("code").alias("stock_count"), F.max("trade_date").alias("latest_ma5_date"))


def on_day(history: DataFrame, day: Column) -> DataFrame:
    """The codes that have a bar on ``day``; a last-day screen needs no others."""
    h = history.where(F.col("trade_date") == day)
    if "trade_year" in history.columns:
        h = h.where(F.col("trade_year") == F.year(day))
    return h.select("code")


# --- history screens ------------------------------------------------------------------------

def ma5_breakout(history: DataFrame, *, latest_only: bool = True, min_value=K.LIQUID_VALUE, up=K.DAILY_UP,
                 vol_floor=K.BREAKOUT_VOLUME_FLOOR) -> DataFrame:
    """S-33: close > MA5, close >= up x previous close, green candle, volume >=
    vol_floor x previous volume, value > min_value — on the last day or every day."""
    w = Window.partitionBy("code").orderBy("trade_date")
    last_day = history.select(F.max("trade_date")).scalar()
    h = recent_rows(history, "code", "trade_date", 6, on_day(history, last_day)) if latest_only else history
    b = with_moving(h, "close", 5, "ma5", "code", "trade_date").withColumns({
        "prev_close": F.lag("close").over(w), "prev_volume": F.lag("volume").over(w)})
    if latest_only:
        b = b.where(F.col("trade_date") == last_day)
    cond = (cross_gt("close", 1, "ma5_sum", "ma5_n") & (F.col("close") >= F.col("prev_close") * dec(up))
            & (F.col("close") >= F.col("open")) & (F.col("volume") >= F.col("prev_volume") * dec(vol_floor))
            & (F.col("value") > F.lit(int(min_value))))
    return b.where(cond).select(
        F.col("code").alias("symbol"), "trade_date", "open", "close", "high", "low", "volume", "value",
        avg_of("ma5").alias("ma5"), "prev_close", "prev_volume",
    ).orderBy(F.col("value").desc(), "symbol", "trade_date")


def ma20_swing(history: DataFrame, *, latest_only: bool = False, min_value=K.LIQUID_VALUE,
               min_price=K.SWING_MIN_PRICE, band_low=K.SWING_BAND_LOW, band_high=K.SWING_BAND_HIGH,
               vol_prev=K.SWING_VOLUME_PREV, vol_ma=K.SWING_VOLUME_MA,
               n: int = 20) -> DataFrame:
    """S-34 / S-35: price within [MA20, 1.03 x MA20], volume surge against yesterday
    and against the 20-day average, full 20-row window, liquid, price > min_price."""
    h = history.where(F.col("close").isNotNull() & F.col("volume").isNotNull() & F.col("value").isNotNull())
    last_day = h.select(F.max("trade_date")).scalar()
    if latest_only:
        h = recent_rows(h, "code", "trade_date", n + 1, on_day(h, last_day))
    h = with_moving(h, "close", n, "pma", "code", "trade_date")
    h = with_moving(h, "volume", n, "vma", "code", "trade_date", "decimal(30,0)")
    h = h.withColumns({
        "previous_volume": F.lag("volume").over(Window.partitionBy("code").orderBy("trade_date")),
        "days_count": F.count(F.lit(1)).over(rows_window("code", "trade_date", n)),
    })
    if latest_only:
        h = h.where(F.col("trade_date") == last_day)
    cond = ((F.col("days_count") == n) & (F.col("value") >= F.lit(int(min_value)))
            & (F.col("close") > F.lit(min_price))
            & cross_ge("close", 1, "pma_sum", "pma_n")
            & cross_ge("close", band_low, "pma_sum", "pma_n")
            & cross_le("close", band_high, "pma_sum", "pma_n")
            & F.col("previous_volume").isNotNull()
            & (F.col("volume") >= dec(vol_prev) * F.col("previous_volume"))
            & cross_ge("volume", vol_ma, "vma_sum", "vma_n"))
    pma, vma = avg_of("pma"), avg_of("vma")
    out = h.where(cond).select(
        "trade_date", F.col("code").alias("security_code"), F.col("close").alias("price"), "volume", "value",
        F.col("freq").alias("frequency"), round_half_away(pma, 2).alias("price_ma20"),
        round_half_away(vma, 0).alias("volume_ma20"), "previous_volume",
        ratio(F.col("close"), pma).alias("price_to_ma20_ratio"),
        ratio("volume", "previous_volume").alias("volume_to_previous_ratio"),
        ratio(F.col("volume"), vma).alias("volume_to_ma20_ratio"),
    )
    if latest_only:
        return out.orderBy(F.col("value").desc(), "security_code")
    return out.orderBy(F.col("trade_date").desc(), F.col("value").desc(), "security_code")


def daily_trading_backtest(summary: DataFrame, *, min_value=K.LIQUID_VALUE, up=K.DAILY_UP, vol_up=K.DAILY_VOLUME_UP,
                           clock: str = "ts", start: int = K.AFTERNOON_START, mid: int = K.AFTERNOON_MID,
                           late: int = K.AFTERNOON_LATE) -> DataFrame:
    """S-31 for every date at once: each day's end-of-day row against its MA5 (over the
    last five end-of-day closes), the previous trading day's volume and that day's
    afternoon volume trend. Restricted to the latest date it equals ``daily_trading_screen``."""
    from bursa.functions.expr import flag, minute_of_day
    d = eod_snapshots(summary, require=["close_price", "trade_volume"])
    d = with_moving(d, "close_price", 5, "ma5", "security_code", "data_date")
    d = d.withColumn("yesterday_volume",
                     F.lag("trade_volume").over(Window.partitionBy("security_code").orderBy("data_date")))
    m = minute_of_day(clock)
    s = summary.where(m >= start)
    trend = s.groupBy("security_code", "data_date").agg(
        F.max(F.when(m.between(start, mid), F.col("trade_volume"))).alias("__v1"),
        F.max(F.when(m.between(mid, late), F.col("trade_volume"))).alias("__v2"),
        F.max(F.when(m >= late, F.col("trade_volume"))).alias("__v3"))
    trend = trend.select("security_code", "data_date",
                         flag((F.col("__v3") > F.col("__v2")) & (F.col("__v2") > F.col("__v1")))
                         .alias("is_volume_increasing"))
    j = d.withColumnRenamed("close_price", "current_price").join(trend, ["security_code", "data_date"])
    cond = (cross_ge("current_price", 1, "ma5_sum", "ma5_n")
            & (F.col("current_price") >= dec(up) * F.col("previous_price"))
            & (F.col("current_price") >= F.col("opening_price"))
            & (F.col("trade_volume") >= dec(vol_up) * F.col("yesterday_volume"))
            & (F.col("trade_value") > F.lit(int(min_value)))
            & F.col("is_volume_increasing"))
    return j.where(cond).select(
        "security_code", "data_date", "current_price", "opening_price", "previous_price",
        avg_of("ma5").alias("ma5"), "trade_volume", "trade_value",
        pct_change("current_price", "previous_price").alias("pct_change"),
    ).orderBy(F.col("data_date").desc(), F.col("trade_value").desc(), "security_code")
