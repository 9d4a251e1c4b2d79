import datetime as dt
from decimal import Decimal as D

from pyspark.sql import Window
from pyspark.sql import functions as F

from bursa.operators.tape import tick_direction, trade_tape_summary
from bursa.sources import adapters as A
from tests.conftest import SF_SMALL
from tests.fixtures import TRADE_ROWS, trades_df


def test_tape_with_one_downtick(spark):
    t = trade_tape_summary(tick_direction(trades_df(spark)), min_trades=1)
    r = {x.security_code: x for x in t.collect()}
    assert r["KAVO"].aggressive_buy_volume == 0
    assert r["KAVO"].price_direction_score == -1
    assert r["KAVO"].total_trade_count == 4
    assert r["LUMA"].price_direction_score == 0
    assert r["PIRA"].trades_per_hour is None  # one trade: zero elapsed time is guarded


def test_same_instant_ties_follow_trade_no(spark):
    rows = [(1, "20250101", "090000", dt.datetime(2025, 1, 1, 9), "X", "RG", D("10.00"), 100),
            (2, "20250101", "090000", dt.datetime(2025, 1, 1, 9), "X", "RG", D("11.00"), 200),
            (3, "20250101", "090000", dt.datetime(2025, 1, 1, 9), "X", "RG", D("10.50"), 300)]
    got = {r.trade_no: (r.is_price_up, r.is_price_down) for r in tick_direction(trades_df(spark, rows)).collect()}
    assert got == {1: (False, False), 2: (True, False), 3: (False, True)}


def test_two_level_lag_equals_plain_lag(spark):
    t = A.trades(spark, SF_SMALL)
    plain = t.withColumn("expected", F.lag("price").over(
        Window.partitionBy("security_code", F.to_date("ts")).orderBy("ts", "trade_no")))
    got = tick_direction(t, slice_minutes=7).join(plain.select("trade_no", "expected"), "trade_no")
    bad = got.where(~F.col("prev_price").eqNullSafe(F.col("expected"))).count()
    assert bad == 0 and got.count() == t.count()


def test_trade_sample_is_unique_by_trade_no():
    assert len({r[0] for r in TRADE_ROWS}) == len(TRADE_ROWS)


def test_two_level_day_cumulative_equals_running_window(spark):
    from bursa.operators.cumulative import day_cumulative
    t = A.trades(spark, SF_SMALL)
    w = (Window.partitionBy("security_code", "trade_date").orderBy("ts", "trade_no")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    plain = t.select("trade_no", F.first("price").over(w).alias("o"), F.max("price").over(w).alias("h"),
                     F.min("price").over(w).alias("l"), F.sum("volume").over(w).alias("v"),
                     F.round(F.sum(F.col("price") * F.col("volume")).over(w), 0).cast("bigint").alias("pv"),
                     F.count(F.lit(1)).over(w).alias("n"))
    got = day_cumulative(t, slice_minutes=7).join(plain, "trade_no")
    bad = got.where((F.col("opening_price") != F.col("o")) | (F.col("highest_price") != F.col("h"))
                    | (F.col("lowest_price") != F.col("l")) | (F.col("trade_volume") != F.col("v"))
                    | (F.col("trade_value") != F.col("pv")) | (F.col("trade_frequency") != F.col("n")))
    assert bad.count() == 0 and got.count() == t.count()
