"""Bursts, as-of joins, sliding extremes, pruned last days and the clustered layout."""
import datetime as dt
import uuid
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from bursa.operators import slices
from bursa.operators.asof_join import asof_join
from bursa.operators.cumulative import day_cumulative
from bursa.operators.latest import nth_last_day, recent_rows
from bursa.operators.rolling import with_extremes, with_wilder_rsi
from bursa.operators.tape import tick_direction
from bursa.plans import sideways as SW
from bursa.plans import swing as SG
from bursa.plans import trend as TR
from bursa.sources import adapters as A
from tests.conftest import SF_SMALL
from tests.test_plans import _plan


def _burst(spark, instants=1):
    """5,000 trades of one symbol in one minute, at so many instants, and some of another."""
    t = spark.range(5000).select(
        F.col("id").alias("trade_no"), F.lit("20250102").alias("trade_date"), F.lit("100000").alias("trade_time"),
        F.timestamp_add("SECOND", (F.col("id") * instants / 5000).cast("int") % 60,
                        F.lit("2025-01-02 10:00:00").cast("timestamp_ntz")).alias("ts"),
        F.when(F.col("id") % 50 == 7, "COLD").otherwise("HOT").alias("security_code"), F.lit("RG").alias("board_code"),
        (F.col("id") * 7919 % 1009 + 1).cast("decimal(12,2)").alias("price"), (F.col("id") % 9 + 1).alias("volume"))
    return t


@pytest.mark.parametrize("instants", [1, 60])
def test_a_burst_is_cut_and_equals_the_plain_lag(spark, instants):
    t = _burst(spark, instants)
    cut, names = slices.with_slices(t, ["security_code", "trade_date"], hot_rows=500, cuts=64)
    sizes = [r["count"] for r in cut.where("security_code = 'HOT'").groupBy(*names).count().collect()]
    assert names == ["__slice", "__sub"] and len(sizes) >= 32 and max(sizes) <= 500
    by = Window.partitionBy("security_code").orderBy("ts", "trade_no")
    plain = t.select("trade_no", F.lag("price").over(by).alias("expected"))
    got = tick_direction(t, hot_rows=500).join(plain, "trade_no")
    assert got.count() == 5000 and got.where(~F.col("prev_price").eqNullSafe(F.col("expected"))).count() == 0
    run = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = t.select("trade_no", F.sum("volume").over(run).alias("v"), F.max("price").over(run).alias("hi"),
                    F.first("price").over(run).alias("open"))
    got = day_cumulative(t, hot_rows=500).join(sums, "trade_no")
    assert got.where((F.col("trade_volume") == F.col("v")) & (F.col("highest_price") == F.col("hi"))
                     & (F.col("opening_price") == F.col("open"))).count() == 5000


def test_without_a_burst_slices_stay_fixed(spark):
    _, names = slices.with_slices(A.trades(spark, SF_SMALL), ["security_code", "trade_date"])
    assert names == ["__slice"]


def _asof(spark):
    day = dt.date
    left = spark.createDataFrame(
        [("a", day(2025, 1, 1), 1), ("a", day(2025, 1, 31), 2), ("a", day(2025, 2, 1), 3), ("a", day(2025, 6, 5), 4),
         ("b", day(2025, 3, 1), 5), ("c", day(2025, 3, 1), 6), (None, day(2025, 3, 1), 7), ("a", None, 8),
         ("a", day(2025, 1, 31), 2)], "code string, d date, n int")
    right = spark.createDataFrame(
        [("a", day(2025, 1, 31), 10), ("a", day(2025, 2, 28), 20), ("a", day(2025, 2, 28), 21), ("b", day(2025, 4, 1), 30),
         (None, day(2025, 1, 1), 40), ("a", None, 50), ("a", day(2025, 4, 30), None)], "code string, t date, v int")
    return left, right


@pytest.mark.parametrize("slice_of", [None, lambda t: F.date_format(t, "yyyy-MM")])
def test_asof_join(spark, slice_of):
    left, right = _asof(spark)
    got = asof_join(left, right, ["code"], "d", "t", ["v"], slice_of=slice_of).collect()
    assert sorted((r.n, r.v) for r in got) == [(1, None), (2, 10), (2, 10), (3, 10), (4, None), (5, None), (6, None),
                                               (7, None), (8, None)]
    strict = asof_join(left, right, ["code"], "d", "t", ["v"], strict=True, slice_of=slice_of).collect()
    assert {r.n: r.v for r in strict}[2] is None and {r.n: r.v for r in strict}[3] == 10
    plan = _plan(asof_join(left, right, ["code"], "d", "t", ["v"]))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_market_cap_of_the_day(spark):
    bars = spark.createDataFrame([("a", dt.date(2025, m, d)) for m, d in ((1, 30), (1, 31), (2, 1), (2, 28), (3, 5))],
                                 "code string, trade_date date")
    caps = spark.createDataFrame([("a", 1, 2025, 100), ("a", 2, 2025, 700)],
                                 "code string, month int, year int, market_capitalization long")
    got = {r.trade_date: r.market_cap_rp for r in SG.with_market_cap(bars, caps).collect()}
    assert got == {dt.date(2025, 1, 30): None, dt.date(2025, 1, 31): 100 * 10 ** 6, dt.date(2025, 2, 1): 100 * 10 ** 6,
                   dt.date(2025, 2, 28): 700 * 10 ** 6, dt.date(2025, 3, 5): 700 * 10 ** 6}


def test_extremes_equal_the_frame_form(spark):
    df = spark.range(700).select((F.col("id") % 3).cast("string").alias("k"), "id",
                                 F.when(F.col("id") % 11 != 5, (F.col("id") * 7919 % 1009)).alias("x"))
    specs = {f"{kind}_{n}": ("x", kind, n) for kind in ("max", "min") for n in (1, 2, 5, 16, 20, 60, 64)}
    got = with_extremes(df, specs, "k", "id")
    for name, (_, kind, n) in specs.items():
        w = Window.partitionBy("k").orderBy("id").rowsBetween(-(n - 1), 0)
        got = got.withColumn(f"w_{name}", (F.max if kind == "max" else F.min)("x").over(w))
    bad = [F.count_if(~F.col(n).eqNullSafe(F.col(f"w_{n}"))).alias(n) for n in specs]
    assert set(got.agg(*bad).first()) == {0}
    plan = _plan(with_extremes(df, specs, "k", "id"))
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_wilder_rsi_stays_in_the_jvm(spark):
    closes = [10, 11, 11, 9, 12, 12.5, 8]
    df = spark.createDataFrame([("a", k, D(str(c)), k) for k, c in enumerate(closes)] + [("b", 0, D("1"), 0)],
                               "code string, day int, close decimal(12,2), extra int")
    got = with_wilder_rsi(df, "close", "code", "day", 3, "rsi")
    want, gain, loss = [None] * 3, 1 / 3, 2 / 3
    want.append(100 - 100 / (1 + gain / loss))
    for a, b in zip(closes[3:], closes[4:]):
        gain, loss = (gain * 2 + max(b - a, 0)) / 3, (loss * 2 + max(a - b, 0)) / 3
        want.append(100 - 100 / (1 + gain / loss))
    rows = {(r.code, r.day): r for r in got.collect()}
    assert len(rows) == 8 and rows["b", 0].rsi is None and rows["a", 6].extra == 6
    assert [rows["a", k].rsi for k in range(7)] == [None if w is None else pytest.approx(w, abs=1e-12) for w in want]
    assert not any(x in _plan(got) for x in ("Pandas", "Python", "Arrow"))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("stored"))
    A.materialize(spark, SF_SMALL, d, names=["trades", "stock_summary", "history_ohlc", "orderbook"])
    return d


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_recent_rows_equal_the_last_rows_of_every_code(spark):
    h = A.history_ohlc(spark, SF_SMALL)
    for n in (1, 6, 201):
        last = F.row_number().over(Window.partitionBy("code").orderBy(F.col("trade_date").desc()))
        want = h.withColumn("p", last).where(F.col("p") <= n).drop("p")
        assert _rows(recent_rows(h, "code", "trade_date", n, h.select("code"))) == _rows(want)
    days = sorted({r[0] for r in h.select("trade_date").collect()})
    at = h.limit(1).select(*[nth_last_day(h, "trade_date", n).alias(f"d{n}") for n in (1, 5, 99_999)]).first()
    assert tuple(at) == (days[-1], days[-5], days[0])


def test_last_day_screens_prune_partitions(spark, stored):
    s, h = A.load(spark, stored, "stock_summary"), A.load(spark, stored, "history_ohlc")
    plan = _plan(TR.daily_trading_screen(s))
    assert plan.count("PartitionFilters: [isnotnull(data_date") >= 2 and "(data_date#" in plan
    scans = [x for x in _plan(SW.sideways_from_summary(s)).splitlines() if "PartitionFilters" in x]
    assert any(">= " in x.split("PartitionFilters")[1].split("PushedFilters")[0] for x in scans)
    for plan in (_plan(TR.ma5_breakout(h)), _plan(TR.ma20_swing(h, latest_only=True))):
        assert "isnotnull(trade_year" in plan
    for df, plain in ((TR.ma5_breakout(h, min_value=0), TR.ma5_breakout(A.history_ohlc(spark, SF_SMALL), min_value=0)),):
        assert _rows(df) == _rows(plain)


def test_sideways_from_summary_equals_the_screen_over_all_bars(spark):
    s = A.stock_summary(spark, SF_SMALL)
    limits = dict(max_range=50, max_volume=5, min_avg_value=0)
    want = SW.sideways_screen(SW.daily_bars(s), 7, **limits)
    assert _rows(SW.sideways_from_summary(s, 7, **limits)) == _rows(want) and want.count()
    past = SW.sideways_screen(SW.daily_bars(s), 7, as_of="2024-01-20", **limits)
    assert _rows(SW.sideways_from_summary(s, 7, as_of="2024-01-20", **limits)) == _rows(past)


def test_book_and_history_are_stored_by_day_and_year(spark, stored):
    book, h = A.load(spark, stored, "orderbook"), A.load(spark, stored, "history_ohlc")
    assert "PartitionFilters: [isnotnull(book_date" in _plan(book.where("book_date = DATE'2024-01-03'"))
    assert "PartitionFilters: [isnotnull(trade_year" in _plan(h.where("trade_year = 2000"))
    assert book.count() == A.orderbook(spark, SF_SMALL).count()


def test_clustered_tables_join_without_an_exchange(spark, tmp_path):
    from bursa.sources.sinks import save_clustered
    tag = uuid.uuid4().hex[:8]
    tables = {}
    for table in ("history_ohlc", "stock_fundamentals", "market_cap"):
        df = A.VIEWS[table](spark, SF_SMALL)
        from bursa.sources.schemas import SCHEMAS
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[table].fields])
        tables[table] = save_clustered(df, table, f"c_{table}_{tag}", f"{tmp_path}/{table}", buckets=4)
    h, f = tables["history_ohlc"], tables["stock_fundamentals"].withColumnRenamed("security_code", "code")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = h.where("trade_year >= 2000").join(f, "code")
        plan = _plan(joined)
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "PartitionFilters: [isnotnull(trade_year" in plan
        assert "Exchange" not in _plan(h.groupBy("code").agg(F.max("close")))
        by = Window.partitionBy("code").orderBy("trade_date")
        assert "Exchange" not in _plan(h.withColumn("p", F.lag("close").over(by)))
        plain = A.history_ohlc(spark, SF_SMALL).where("trade_date >= DATE'2000-01-01'").join(
            A.stock_fundamentals(spark, SF_SMALL).withColumnRenamed("security_code", "code"), "code")
        assert joined.count() == plain.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for table in tables:
            spark.sql(f"DROP TABLE c_{table}_{tag}")


def test_entry_screens_have_rows(spark):
    for name in ("rebound_strict_backtest", "ma20_swing_last_hit", "rebound_strict_loose"):
        assert E._QUERIES[name](spark, "/root/testdata/sf0.01").count() > 0, name
