import datetime as dt
import tempfile
from decimal import Decimal as D

from pyspark.sql import functions as F

from bursa.plans import sideways as SW
from bursa.sources import adapters as A
from tests.conftest import SF_SMALL


def _daily(spark, rows):
    return spark.createDataFrame(
        [(dt.datetime(2025, 1, d), "X", D(c), D(c), D(c), D(c), v, v * 100) for d, c, v in rows],
        "bucket timestamp_ntz, security_code string, open decimal(12,2), high decimal(12,2), "
        "low decimal(12,2), close decimal(12,2), volume bigint, value bigint")


def test_state_flags_narrow_range_and_low_volume(spark):
    rows = [(1, "100.00", 1000), (2, "101.00", 1000), (3, "102.00", 1000), (6, "101.50", 100)]
    st = SW.sideways_state(_daily(spark, rows), 60, min_avg_value=10_000).first()
    assert st.trade_date == dt.date(2025, 1, 6)
    assert abs(st.range_ratio - 0.02) < 1e-12 and abs(st.volume_ratio - 0.1) < 1e-12
    assert st.is_sideways


def test_state_without_history_is_zero_and_false(spark):
    st = SW.sideways_state(_daily(spark, [(5, "100.00", 10)]), 60).first()
    assert (st.range_ratio, st.volume_ratio, st.is_sideways) == (0.0, 0.0, False)


def test_upsert_twice_equals_once(spark):
    state = SW.sideways_state(A.daily_ohlc(spark, SF_SMALL), 60, last_day_only=False)
    path = tempfile.mkdtemp(prefix="bursa-test-upsert-") + "/state"
    SW.store_sideways(state, path)
    once = SW.read_sideways(spark, path)
    n1 = once.count()
    SW.store_sideways(state.where(F.col("trade_date") >= F.lit("2001-01-01").cast("date")), path)
    twice = SW.read_sideways(spark, path)
    assert twice.count() == n1 == state.count()
    assert twice.exceptAll(state).count() == 0


def test_upsert_of_repeated_keys_takes_the_first_under_the_order(spark, tmp_path):
    from pyspark.sql import functions as F

    from bursa.sources.sinks import upsert
    rows = spark.createDataFrame([("a", 1, 1), ("a", 3, 1), ("a", 2, 1)], "k string, v int, p int")
    for order, want in (([F.col("v")], 1), (None, 3)):
        upsert(rows, f"{tmp_path}/{want}", ["k"], ["p"], order)
        assert [r.v for r in spark.read.parquet(f"{tmp_path}/{want}").collect()] == [want]


def test_upsert_replaces_changed_rows(spark):
    base = spark.createDataFrame([("A", dt.date(2025, 1, 1), 1.0, 1.0, False),
                                  ("B", dt.date(2025, 1, 1), 2.0, 2.0, False)],
                                 "symbol string, trade_date date, range_ratio double, volume_ratio double, "
                                 "is_sideways boolean")
    path = tempfile.mkdtemp(prefix="bursa-test-upsert-") + "/state"
    SW.store_sideways(base, path)
    SW.store_sideways(base.where("symbol = 'A'").withColumn("is_sideways", F.lit(True)), path)
    got = {r.symbol: r.is_sideways for r in SW.read_sideways(spark, path).collect()}
    assert got == {"A": True, "B": False}


def test_as_of_reruns_a_past_night(spark):
    bars = A.daily_ohlc(spark, SF_SMALL)
    all_days = SW.sideways_state(bars, 60, last_day_only=False)
    night = all_days.select(F.min("trade_date")).first()[0]
    import datetime as _d
    night = night + _d.timedelta(days=90)
    past = SW.sideways_state(bars, 60, as_of=night.isoformat())
    exp = all_days.where(F.col("trade_date") == F.lit(night.isoformat()).cast("date"))
    if exp.count() == 0:  # no bars that night: the state is for the last trading day before it
        last = bars.where(F.to_date("bucket") <= F.lit(night.isoformat()).cast("date")).select(
            F.max(F.to_date("bucket"))).first()[0]
        exp = all_days.where(F.col("trade_date") == F.lit(last.isoformat()).cast("date"))
    assert past.exceptAll(exp).count() == 0 and exp.exceptAll(past).count() == 0
