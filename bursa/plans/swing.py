"""The 13-rule swing screen (S-41) with its indicators (E-12..E-14).

Indicators are windows over one symbol's daily bars: moving sums/counts for
MA50/100/200 and the 20/60-day average volume, highest/lowest over 60 days,
highest over 20 days and a simple-average RSI(14). Market cap is the one known on the
bar's day: the last month of the market-cap table (stored in millions) that had ended by
then, found by an as-of join, so no past day sees a later month. Free float comes from a
frame the caller supplies. Every rule is a flag column; comparisons are exact, and a rule
over n bars needs n bars.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bursa import constants as K

from bursa.functions.expr import dec, flag, guarded_ratio
from bursa.operators.asof_join import asof_join
from bursa.operators.latest import latest_per_key, recent_rows
from bursa.operators.rolling import with_extremes, with_moving_sums, with_rsi, with_wilder_rsi
from bursa.plans.trend import on_day

RULES = [f"rule_{i:02d}" for i in range(1, 14)]


def with_market_cap(bars: DataFrame, market_cap: DataFrame) -> DataFrame:
    """``market_cap_rp``: the capitalisation in rupiah of the last month that had ended by
    the bar's day (its month-end is that day or before it); NULL before a code's first."""
    caps = market_cap.select(
        "code", F.last_day(F.make_date("year", "month", F.lit(1))).alias("cap_date"),
        (F.col("market_capitalization").cast("decimal(30,0)") * F.lit(K.MARKET_CAP_UNIT)).alias("market_cap_rp"))
    return asof_join(bars, caps, ["code"], "trade_date", "cap_date", ["market_cap_rp"])


def free_float_from_master(stock_master: DataFrame) -> DataFrame:
    """Free float per code from stock-master records (type A): tradable / listed shares
    in percent, from each code's latest record when a ``received_at`` column exists."""
    sm = stock_master
    if "received_at" in sm.columns:
        sm = latest_per_key(sm, ["security_code"], [F.col("received_at").desc()])
    pct = F.when(F.col("listed_shares") > 0, F.col("tradable_listed_shares").cast("double")
                 / F.col("listed_shares").cast("double") * F.lit(100.0))
    return sm.select(F.col("security_code").alias("code"), pct.alias("free_float_pct"))


def swing_screen(history: DataFrame, market_cap: DataFrame, free_float: DataFrame, *,
                 latest_only: bool = True, only_passing: bool = True, max_market_cap=K.MAX_MARKET_CAP,
                 max_free_float=K.MAX_FREE_FLOAT, min_value=K.LIQUID_VALUE, max_range_60=K.MAX_RANGE_60, rsi_low=K.RSI_LOW, rsi_high=K.RSI_HIGH,
                 max_close_ma200=K.MAX_CLOSE_MA200, max_candle=K.MAX_CANDLE, price_col: str = "close",
                 include_today: bool = True, rsi_method: str = "simple") -> DataFrame:
    """Evaluate the 13 rules per symbol-day; ``free_float`` has ``code, free_float_pct``.

    ``rsi_method``: ``"simple"`` (rolling averages, windows only) or ``"wilder"``
    (recursive smoothing, folded per symbol by ``aggregate``)."""
    h = history.where(F.col("close").isNotNull())
    if latest_only and rsi_method == "simple":
        # the longest window, and one bar before it
        h = recent_rows(h, "code", "trade_date", 201, on_day(history, history.select(F.max("trade_date")).scalar()))
    h = with_market_cap(h, market_cap)  # first, while rows are narrow: the windows below reuse its exchange
    specs = {f"__m{n}": ("close", n, "decimal(30,2)") for n in (50, 100, 200)}
    specs.update({f"__v{n}": ("volume", n, "decimal(30,0)") for n in (20, 60)})
    h = with_moving_sums(h, specs, "code", "trade_date")
    h = h.withColumnsRenamed({**{f"__m{n}_sum": f"__s{n}" for n in (50, 100, 200)},
                              **{f"__m{n}_n": f"__n{n}" for n in (50, 100, 200)},
                              **{f"__v{n}_sum": f"__vs{n}" for n in (20, 60)},
                              **{f"__v{n}_n": f"__vn{n}" for n in (20, 60)}})
    h = with_extremes(h, {"highest_60": (price_col, "max", 60), "lowest_60": (price_col, "min", 60),
                          "highest_20": (price_col, "max", 20)}, "code", "trade_date")
    by_day = Window.partitionBy("code").orderBy("trade_date")
    h = h.withColumn("__rows", F.row_number().over(by_day))
    if not include_today:
        h = h.withColumn("highest_20", F.lag("highest_20").over(by_day))
    if rsi_method == "wilder":
        h = with_wilder_rsi(h, "close", "code", "trade_date", 14, "rsi_14")
    elif rsi_method == "simple":
        h = with_rsi(h, "close", "code", "trade_date", 14, "rsi_14")
    else:
        raise ValueError("rsi_method is 'simple' or 'wilder'")
    if latest_only:
        h = h.where(F.col("trade_date") == history.select(F.max("trade_date")).scalar())
    h = h.join(free_float.select("code", "free_float_pct"), "code", "left")

    def gt_avg(s1, n1, s2, n2) -> Column:  # s1/n1 > s2/n2, exact
        return F.col(s1) * F.col(n2) > F.col(s2) * F.col(n1)

    def full(n: int) -> Column:  # an average over n bars needs n bars
        return F.col(f"__n{n}") == n

    def bars(n: int) -> Column:
        return F.col("__rows") >= n

    c = F.col("close")
    rules = {
        "rule_01": F.col("market_cap_rp").isNotNull() & (F.col("market_cap_rp") < F.lit(int(max_market_cap))),
        "rule_02": F.col("free_float_pct").isNotNull() & (F.col("free_float_pct") < F.lit(max_free_float)),
        "rule_03": full(50) & (c * F.col("__n50") > F.col("__s50")),
        "rule_04": full(100) & gt_avg("__s50", "__n50", "__s100", "__n100"),
        "rule_05": full(200) & gt_avg("__s100", "__n100", "__s200", "__n200"),
        "rule_06": (F.col("__vn60") == 60) & gt_avg("__vs20", "__vn20", "__vs60", "__vn60"),
        "rule_07": (F.col("__vn20") == 20) & (F.col("volume") * F.col("__vn20") > F.col("__vs20")),
        "rule_08": F.col("value") > F.lit(int(min_value)),
        "rule_09": bars(60) & (F.col("lowest_60") > 0) & (F.col("highest_60") < dec(max_range_60) * F.col("lowest_60")),
        "rule_10": bars(20 if include_today else 21) & (F.col(price_col) >= F.col("highest_20")),
        "rule_11": (F.col("rsi_14") > F.lit(float(rsi_low))) & (F.col("rsi_14") < F.lit(float(rsi_high))),
        "rule_12": full(200) & (c * F.col("__n200") < dec(max_close_ma200) * F.col("__s200")),
        "rule_13": (c > 0) & ((F.col("high") - F.col("low")) < dec(max_candle) * c),
    }
    h = h.withColumns({k: flag(v) for k, v in rules.items()})
    met = sum((F.col(k).cast("int") for k in RULES), F.lit(0))
    out = h.select(
        F.col("code").alias("security_code"), "trade_date", "close", "volume", "value",
        guarded_ratio("__s50", "__n50").alias("ma50"), guarded_ratio("__s100", "__n100").alias("ma100"),
        guarded_ratio("__s200", "__n200").alias("ma200"),
        guarded_ratio("__vs20", "__vn20").alias("avg_volume_20"),
        guarded_ratio("__vs60", "__vn60").alias("avg_volume_60"),
        "highest_60", "lowest_60", "highest_20", "rsi_14", "market_cap_rp", "free_float_pct",
        *RULES, met.cast("int").alias("rules_met"))
    if only_passing:
        out = out.where(F.col("rules_met") == len(RULES))
    return out.orderBy(F.col("trade_date").desc(), F.col("value").desc(), "security_code")
