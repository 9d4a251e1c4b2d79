"""Cross-operator properties on the small test tables."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from bursa.sources.sinks import load_market_cap
from bursa.sources.schemas import validate
from tests.conftest import SF_SMALL

SF_MID = "/root/testdata/sf0.01"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_asof_equals_backtest_on_its_day(spark):
    q = E._QUERIES
    one = q["rebound_asof"](spark, SF_MID)
    every = q["rebound_asof_backtest"](spark, SF_MID)
    day = one.select(F.max("data_date")).first()[0]
    if day is None:
        pytest.skip("no as-of rows")
    assert _rows(one) == _rows(every.where(F.col("data_date") == day))


def test_strict_subset_of_relaxed(spark):
    strict = E._QUERIES["rebound_strict"](spark, SF_MID).select("security_code")
    relaxed = E._QUERIES["rebound_relaxed"](spark, SF_MID).select("security_code")
    assert strict.exceptAll(relaxed).count() == 0


def test_backtest_latest_day_matches_summary_detail_scores(spark):
    bt = E._QUERIES["rebound_backtest"](spark, SF_SMALL)
    assert bt.where(F.col("criteria_met") < 4).count() == 0


def test_market_cap_load_rounds_half_up(spark):
    raw = spark.createDataFrame(
        [("BBCA", "Bank", "122042299500", "1104482810.5", "11.28", 4, 2023),
         ("BBRI", "Bank", "150043411587", "765221399.49", "7.82", 4, 2023)],
        "code string, listed_stocks string, number_of_listed_shares string, market_capitalization string, "
        "percentage string, month int, year int")
    got = {r.code: r.market_capitalization for r in load_market_cap(raw).collect()}
    assert got == {"BBCA": 1104482811, "BBRI": 765221399}


def test_validate_rejects_wrong_types(spark):
    df = spark.createDataFrame([("X", 1)], "security_code string, shares_outstanding int")
    with pytest.raises(ValueError):
        validate(df, "stock_fundamentals")


def test_price_decimals_are_exact(spark):
    df = spark.createDataFrame([(D("0.10"), D("0.20"))], "a decimal(12,2), b decimal(12,2)")
    assert df.select((F.col("a") + F.col("b")).alias("s")).first().s == D("0.30")


def test_daily_backtest_on_latest_day_equals_daily_screen(spark):
    one = E._QUERIES["daily_screen"](spark, SF_MID)
    s = E._v(spark, SF_MID, "stock_summary")
    day = s.select(F.max("data_date")).first()[0]
    every = E._QUERIES["daily_screen_backtest"](spark, SF_MID).where(F.col("data_date") == day).drop("data_date")
    assert _rows(one) == _rows(every)


def test_swing_wilder_option_uses_wilder_rsi(spark):
    from bursa.plans.swing import swing_screen
    from bursa.sources import adapters as A
    h = A.history_ohlc(spark, SF_SMALL)
    sw = swing_screen(h, A.market_cap(spark, SF_SMALL), A.free_float(spark, SF_SMALL), latest_only=False,
                      only_passing=False, rsi_method="wilder")
    ref = E._QUERIES["rsi14_wilder"](spark, SF_SMALL)
    j = sw.select(F.col("security_code").alias("code"), "trade_date", "rsi_14").join(ref, ["code", "trade_date"])
    assert j.count() == h.count()
    assert j.where(~F.col("rsi_14").eqNullSafe(F.col("rsi_wilder"))).count() == 0
