"""

Every query runs on the adapter views of ``bursa.sources.adapters`` (derived from
the driver's tables) over the whole tables. ``oracle_sql`` holds an independent
DuckDB text per query over the same raw tables (view texts in
``bursa.plans.oracle_views``).

Presentation: results leave Spark through ``_present`` — decimals become doubles,
dates ``yyyy-MM-dd`` text, timestamps ``yyyy-MM-dd HH:mm:ss.SSSSSS`` text, integers
bigint — and every oracle casts its output the same way, so both sides hash alike.

Test parameters (thresholds scaled to the synthetic prices, SURVEY §7.5):
summary value floor 100,000; history value floor 1,000,000; as-of = the latest date
of the table; minimum days 3; minimum trades 3; sideways range 20, volume 0.5.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bursa.operators import audit as AU
from bursa.operators import tape as TP
from bursa.operators.latest import eod_snapshots, latest_per_key, max_data_date
from bursa.operators.rolling import with_rsi, with_wilder_rsi
from bursa.plans import asof as AO
from bursa.plans import diagnostics as DG
from bursa.plans import market as MK
from bursa.plans import rebound as RB
from bursa.plans import sideways as SW
from bursa.plans import swing as SG
from bursa.plans import trend as TR
from bursa.plans.oracle_views import with_views
from bursa.session import checkpoint_dir
from bursa.sources import adapters as A
from bursa.sources import feed as FD
from bursa.sources.schemas import KEYS, SCHEMAS
from bursa.streaming import live as ST

SF_SMOKE = "/root/testdata/sf0.001"

# Test parameters (fixed values of the test harness).
SUMMARY_MIN_VALUE = 100_000
HISTORY_MIN_VALUE = 1_000_000
MIN_DAYS = 3
MIN_TRADES = 3
SIDEWAYS_RANGE = 20
SIDEWAYS_VOLUME = 0.5
LOOSE_SHADOW = 0.2


def _present(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(f.name))
    return df.select(*out)


def _dbl(df: DataFrame, *cols: str) -> DataFrame:
    """Integer columns that can hold NULL are presented as doubles (pandas turns a
    nullable integer into float64 on one side and Int64 on the other)."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def _v(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return A.load(spark, sf, name)


# ---------------------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------------------

def q_rebound_candidates(spark, sf):
    return RB.rebound_candidates(_v(spark, sf, "stock_summary"), 20, min_value=SUMMARY_MIN_VALUE)


def q_criteria_counts(spark, sf):
    return RB.criteria_counts(_v(spark, sf, "stock_summary"), min_value=SUMMARY_MIN_VALUE)


def q_rebound_detail(spark, sf):
    return RB.momentum_rebound_detail(_v(spark, sf, "stock_summary"), _v(spark, sf, "history_ohlc"),
                                      min_value=SUMMARY_MIN_VALUE)


def q_rebound_detail_summary(spark, sf):
    return RB.momentum_rebound_detail(_v(spark, sf, "stock_summary"), None, min_value=SUMMARY_MIN_VALUE,
                                      min_days=MIN_DAYS)


def q_rebound_detail_3b(spark, sf):
    return RB.momentum_rebound_detail(_v(spark, sf, "stock_summary"), None, min_value=SUMMARY_MIN_VALUE,
                                      min_days=MIN_DAYS, with_3b=True)


def _strict(spark, sf, k, **factors):
    s, h = _v(spark, sf, "stock_summary"), _v(spark, sf, "history_ohlc")
    return RB.momentum_rebound_strict(s, h, as_of=s.select(F.max("data_date")).scalar(),
                                      history_as_of=h.select(F.max("trade_date")).scalar(),
                                      min_criteria=k, min_value=SUMMARY_MIN_VALUE, min_days=MIN_DAYS, **factors)


def q_rebound_strict(spark, sf):
    return _strict(spark, sf, 5)


def q_rebound_strict_loose(spark, sf):
    """The strict screen with a lower shadow that the synthetic prices reach."""
    return _strict(spark, sf, 5, shadow=LOOSE_SHADOW)


def q_rebound_strict_backtest(spark, sf):
    """All five criteria on every date, with the screen's own factors."""
    return RB.rebound_backtest(_v(spark, sf, "stock_summary"), min_criteria=5, min_days=MIN_DAYS,
                               min_value=SUMMARY_MIN_VALUE)


def q_avg_volume_daily(spark, sf):
    s = _v(spark, sf, "stock_summary")
    return _dbl(RB.avg_volume_daily(eod_snapshots(s), max_data_date(s), MIN_DAYS), "vol_sum")


def q_range_stats(spark, sf):
    s = _v(spark, sf, "stock_summary")
    return RB.range_stats(eod_snapshots(s), max_data_date(s), MIN_DAYS)


def q_rebound_relaxed(spark, sf):
    return _strict(spark, sf, 4)


def _hist_asof(h):
    return h.select(F.max("trade_date")).scalar()


def q_rebound_backtest(spark, sf):
    return RB.rebound_backtest(_v(spark, sf, "stock_summary"), min_criteria=4, min_days=MIN_DAYS,
                               min_value=SUMMARY_MIN_VALUE)


def q_table_counts(spark, sf):
    return DG.table_counts({"orderbook": _v(spark, sf, "orderbook"), "trades": _v(spark, sf, "trades"),
                            "stock_summary": _v(spark, sf, "stock_summary")})


def q_coverage_summary(spark, sf):
    return DG.coverage(_v(spark, sf, "stock_summary"), "stock_summary")


def q_coverage_history(spark, sf):
    return DG.coverage(_v(spark, sf, "history_ohlc"), "history_ohlc", code="code", day="trade_date")


def q_coverage_today(spark, sf):
    s = _v(spark, sf, "stock_summary")
    return DG.coverage_on(s, max_data_date(s))


def q_coverage_current_date(spark, sf):
    """Today's coverage by ``CURRENT_DATE``: the snapshots moved so that their last day is today."""
    from bursa.operators.latest import as_of_text
    s = _v(spark, sf, "stock_summary")
    day = F.to_date("data_date", "yyyyMMdd")
    behind = F.datediff(F.current_date(), F.to_date(max_data_date(s), "yyyyMMdd"))
    moved = s.withColumn("data_date", F.date_format(F.date_add(day, behind), "yyyyMMdd"))
    return DG.coverage_on(moved, as_of_text(None))


def q_sample_latest(spark, sf):
    return DG.sample_latest(_v(spark, sf, "stock_summary"), 10)


def q_latest_date(spark, sf):
    return DG.latest_date(_v(spark, sf, "stock_summary"))


def q_date_match(spark, sf):
    s = _v(spark, sf, "stock_summary")
    return DG.date_match(s, max_data_date(s))


def q_missing_fundamentals(spark, sf):
    h = _v(spark, sf, "history_ohlc")
    return DG.missing_fundamentals(h, _v(spark, sf, "stock_fundamentals"), _hist_asof(h),
                                   min_value=HISTORY_MIN_VALUE)


def q_fundamentals_coverage(spark, sf):
    h = _v(spark, sf, "history_ohlc")
    return DG.fundamentals_coverage(h, _v(spark, sf, "stock_fundamentals"), _hist_asof(h))


def q_latest_snapshot(spark, sf):
    from bursa.operators.latest import latest_snapshot
    return latest_snapshot(_v(spark, sf, "stock_summary"))


def q_eod_snapshots(spark, sf):
    return eod_snapshots(_v(spark, sf, "stock_summary"))


def q_previous_day_merged(spark, sf):
    s = _v(spark, sf, "stock_summary")
    return RB.previous_day_merged(s, _v(spark, sf, "history_ohlc"), max_data_date(s))


def q_afternoon_trend(spark, sf):
    from bursa.operators.session import afternoon_volume_trend
    s = _v(spark, sf, "stock_summary")
    return _dbl(afternoon_volume_trend(s, max_data_date(s)), "volume_1430_1500", "volume_1500_1530",
                "volume_1530_close")


def q_afternoon_counts(spark, sf):
    return TR.afternoon_counts(_v(spark, sf, "stock_summary"))


def q_snapshot_counts(spark, sf):
    return TR.snapshot_counts(_v(spark, sf, "stock_summary"), min_value=SUMMARY_MIN_VALUE)


def q_daily_screen(spark, sf):
    return TR.daily_trading_screen(_v(spark, sf, "stock_summary"), min_value=SUMMARY_MIN_VALUE)


def q_daily_screen_backtest(spark, sf):
    return TR.daily_trading_backtest(_v(spark, sf, "stock_summary"), min_value=SUMMARY_MIN_VALUE)


def q_daily_marks(spark, sf):
    return _dbl(TR.daily_trading_marks(_v(spark, sf, "stock_summary"), _v(spark, sf, "history_ohlc"), 10,
                                       min_value=SUMMARY_MIN_VALUE), "yesterday_volume")


def q_ma_coverage(spark, sf):
    return TR.ma_coverage(_v(spark, sf, "history_ohlc"), 5)


def q_ma5_breakout(spark, sf):
    return TR.ma5_breakout(_v(spark, sf, "history_ohlc"), latest_only=True, min_value=HISTORY_MIN_VALUE)


def q_ma5_breakout_all(spark, sf):
    return TR.ma5_breakout(_v(spark, sf, "history_ohlc"), latest_only=False, min_value=HISTORY_MIN_VALUE)


def q_ma20_swing(spark, sf):
    return TR.ma20_swing(_v(spark, sf, "history_ohlc"), min_value=HISTORY_MIN_VALUE)


def q_ma20_swing_latest(spark, sf):
    return TR.ma20_swing(_v(spark, sf, "history_ohlc"), latest_only=True, min_value=HISTORY_MIN_VALUE)


def q_ma20_swing_last_hit(spark, sf):
    """The latest-day screen as of the last day on which any symbol passes."""
    h = _v(spark, sf, "history_ohlc")
    hits = TR.ma20_swing(h, latest_only=False, min_value=HISTORY_MIN_VALUE)
    past = h.where(F.col("trade_date") <= hits.select(F.max("trade_date")).scalar())
    return TR.ma20_swing(past, latest_only=True, min_value=HISTORY_MIN_VALUE)


def q_daily_bars(spark, sf):
    return SW.daily_bars(_v(spark, sf, "stock_summary"))


def q_daily_ohlc_build(spark, sf):
    return SW.build_daily_ohlc(_v(spark, sf, "stock_summary"))


def _sw7(spark, sf, last):
    if last:  # only the last days' partitions
        return SW.sideways_from_summary(_v(spark, sf, "stock_summary"), 7, max_range=SIDEWAYS_RANGE,
                                        max_volume=SIDEWAYS_VOLUME, min_avg_value=SUMMARY_MIN_VALUE)
    return SW.sideways_screen(SW.daily_bars(_v(spark, sf, "stock_summary")), 7, max_range=SIDEWAYS_RANGE,
                              max_volume=SIDEWAYS_VOLUME, min_avg_value=SUMMARY_MIN_VALUE, last_day_only=last)


def q_sideways_7d(spark, sf):
    return _sw7(spark, sf, True)


def q_sideways_7d_all(spark, sf):
    return _sw7(spark, sf, False)


def _sw60(spark, sf, last):
    return SW.sideways_state(_v(spark, sf, "daily_ohlc"), 60, max_range=SIDEWAYS_RANGE,
                             max_volume=SIDEWAYS_VOLUME, min_avg_value=HISTORY_MIN_VALUE, last_day_only=last)


def q_sideways_60d(spark, sf):
    return _sw60(spark, sf, True)


def q_sideways_60d_asof(spark, sf):
    """The nightly state re-run for a past night: one year before the last bar."""
    d = _v(spark, sf, "daily_ohlc")
    night = F.date_sub(d.select(F.to_date(F.max("bucket"))).scalar(), 365)
    return SW.sideways_state(d, 60, max_range=SIDEWAYS_RANGE, max_volume=SIDEWAYS_VOLUME,
                             min_avg_value=HISTORY_MIN_VALUE, as_of=night)


def q_sideways_60d_all(spark, sf):
    return _sw60(spark, sf, False)


def q_current_sideways(spark, sf):
    return SW.current_sideways(_sw60(spark, sf, False))


def q_sideways_upsert(spark, sf):
    """Back-fill the state of every day, upsert the last night again (idempotent),
    and read the stored table back."""
    import uuid
    path = f"{checkpoint_dir(spark).rstrip('/')}/sideways_state-{uuid.uuid4().hex}"
    SW.store_sideways(_sw60(spark, sf, False), path)
    SW.store_sideways(_sw60(spark, sf, True), path)
    return SW.read_sideways(spark, path)


def q_tick_direction(spark, sf):
    return TP.tick_direction(_v(spark, sf, "trades")).drop("trade_date", "trade_time", "board_code")


def q_trade_tape_summary(spark, sf):
    return TP.trade_tape_summary(TP.tick_direction(_v(spark, sf, "trades")), min_trades=MIN_TRADES)


def q_rebound_asof(spark, sf):
    s = _v(spark, sf, "stock_summary")
    day = F.to_date(max_data_date(s), "yyyyMMdd")
    return AO.momentum_rebound_asof(s, _v(spark, sf, "trades"), day, min_trades=MIN_TRADES,
                                    min_value=SUMMARY_MIN_VALUE)


def q_rebound_asof_backtest(spark, sf):
    return AO.momentum_rebound_backtest(_v(spark, sf, "stock_summary"), _v(spark, sf, "trades"),
                                        min_trades=MIN_TRADES, min_value=SUMMARY_MIN_VALUE)


def q_top_gainers(spark, sf):
    return MK.top_movers(_v(spark, sf, "stock_summary"), 10, "gainer")


def q_top_losers(spark, sf):
    return MK.top_movers(_v(spark, sf, "stock_summary"), 10, "loser")


def q_most_active(spark, sf):
    return MK.most_active(_v(spark, sf, "stock_summary"), 10)


def q_book_totals(spark, sf):
    return MK.book_totals(_v(spark, sf, "orderbook"))


AUDITED = ["stock_summary", "trades", "orderbook", "history_ohlc", "stock_fundamentals"]
NULL_AUDITED = ["stock_summary", "trades", "orderbook"]


def q_key_audit(spark, sf):
    return AU.key_violation_counts({t: (_v(spark, sf, t), KEYS[t]) for t in AUDITED})


def q_null_audit(spark, sf):
    parts = [AU.null_violations(_v(spark, sf, t), AU.not_null_columns(SCHEMAS[t]), t) for t in NULL_AUDITED]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _swing(spark, sf, latest):
    return SG.swing_screen(_v(spark, sf, "history_ohlc"), _v(spark, sf, "market_cap"), _v(spark, sf, "free_float"),
                           latest_only=latest, only_passing=False, min_value=HISTORY_MIN_VALUE)


def q_swing_spec(spark, sf):
    return _swing(spark, sf, False)


def q_swing_latest(spark, sf):
    return _swing(spark, sf, True)


def q_rsi14(spark, sf):
    h = _v(spark, sf, "history_ohlc").where(F.col("close").isNotNull())
    return with_rsi(h, "close", "code", "trade_date", 14, "rsi_14").select("code", "trade_date", "close", "rsi_14")


def q_feed_trades(spark, sf):
    return FD.feed_trades(FD.trades_to_lines(_v(spark, sf, "trades")))


def q_feed_summary(spark, sf):
    return FD.feed_summary(FD.summary_to_lines(_v(spark, sf, "stock_summary")))


def q_feed_orderbook(spark, sf):
    return FD.feed_orderbook(FD.orderbook_to_lines(_v(spark, sf, "orderbook")))


def q_feed_book_summary(spark, sf):
    t = MK.book_totals(_v(spark, sf, "orderbook"))
    lines = t.select(F.concat_ws("|", F.lit("ANTR"), F.lit("C"), "security_code",
                                 *[F.col(c).cast("string") for c in t.columns[1:]]).alias("value"))
    return FD.feed_book_summary(lines)


def q_feed_rank_lists(spark, sf):
    """Daily most-active lists (top 10 by end-of-day value) replayed as type-7 lines."""
    from pyspark.sql import Window
    d = eod_snapshots(_v(spark, sf, "stock_summary"))
    r = d.withColumn("rank", F.row_number().over(
        Window.partitionBy("data_date").orderBy(F.col("trade_value").desc(), "security_code"))).where("rank <= 10")
    g = r.groupBy("data_date").agg(F.array_sort(F.collect_list(F.struct("rank", "security_code"))).alias("l"))
    lines = g.select(F.concat(F.lit("ANTR|7|"), F.array_join(F.transform("l", lambda x: x["security_code"]), "|"),
                              F.lit("|")).alias("value"), F.col("data_date").alias("received_at"))
    return FD.feed_rank_lists(lines)


def q_feed_rejects(spark, sf):
    """Trades replayed as type-1 lines; negotiated-board lines lose their volume field."""
    t = _v(spark, sf, "trades")
    good = FD.trades_to_lines(t.where(F.col("board_code") != "NG"))
    bad = t.where(F.col("board_code") == "NG").select(F.concat_ws(
        "|", F.lit("ANTR"), F.lit("1"), "trade_date", "trade_time", "security_code", "board_code",
        F.col("trade_no").cast("string"), F.col("price").cast("string")).alias("value"))
    return FD.feed_rejects(good.unionByName(bad)).groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"))


# A line of every form, by trade number: the way a line can be read, or why it can't.
ODD_LINES = ["concat_ws('|', 'ANTR', '1', trade_date, trade_time, security_code, board_code, trade_no, price, volume)",
             "concat_ws('|', 'XNTR', '1', trade_no)", "concat_ws('|', 'ANTR', 'Q', trade_no)",
             "concat_ws('|', 'ANTR', 'C', security_code, trade_no)",
             "concat_ws('|', 'ANTR', 'C', security_code, trade_no, 'x', 3, 4)",
             "concat_ws('|', 'ANTR', 'C', '', trade_no, 2, 3, 4)", "'ANTR|5|'", "'ANTR|7||||'",
             "concat('ANTR|3|', security_code, '|{0}')", "'ANTR|3||{0}1;2;3|'",
             "concat('ANTR|4|', security_code, '|{1}1;x;3|')",
             "concat('ANTR|4|', security_code, '|{1}1;', price, ';3|2;', price, ';', volume, '|')",
             "concat('ANTR|6|', security_code, '||', security_code, '|')"]


def _odd_lines(spark, sf):
    t = _v(spark, sf, "trades")
    forms = " ".join(f"WHEN {k} THEN {form}" for k, form in enumerate(ODD_LINES))
    return t.select(F.expr(f"CASE trade_no % {len(ODD_LINES)} {forms} END").alias("value"))


def q_feed_reject_reasons(spark, sf):
    return FD.feed_rejects(_odd_lines(spark, sf)).groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"))


def q_feed_conservation(spark, sf):
    return FD.feed_conservation(_odd_lines(spark, sf))


def q_feed_trades_eod(spark, sf):
    return FD.feed_trades_eod(_v(spark, sf, "trades_eod").select(FD.eod_line().alias("value")))


def _record(kind: str, *fields) -> F.Column:
    return F.concat_ws("|", F.lit("ANTR"), F.lit(kind), *[F.expr(f).cast("string") for f in fields]).alias("value")


def q_feed_index(spark, sf):
    """One index record a day: the sums of the day's bars; value and market value in E-notation."""
    from pyspark.sql import Window
    d = _v(spark, sf, "history_ohlc").groupBy("trade_date").agg(
        *[F.sum(c).cast("decimal(20,2)").alias(f"s_{c}") for c in ("open", "high", "low", "close")],
        F.sum("freq").alias("freq"), F.sum("volume").alias("volume"), F.sum("value").alias("value"),
        F.count_if(F.col("close") > F.col("open")).alias("up"), F.count_if(F.col("close") < F.col("open")).alias("down"),
        F.count_if(F.col("close") == F.col("open")).alias("same"))
    d = d.withColumn("prev", F.coalesce(F.lag("s_close").over(Window.orderBy("trade_date")), "s_close"))
    return FD.feed_index(d.select(_record(
        "9", "'COMPX'", "date_format(trade_date, 'yyyyMMdd')", "'160000'", "s_close", "prev", "s_open", "s_high",
        "s_low", "CAST(s_close - prev AS DECIMAL(20,2))", "'0.00'", "freq", "volume div 100", "concat(value, 'E2')",
        "up", "down", "same", "0", "concat(value, '.5E3')")))


def q_feed_stock_master(spark, sf):
    f = _v(spark, sf, "stock_fundamentals")
    return FD.feed_stock_master(f.select(_record(
        "A", "security_code", "source", "0", "'ORDI'", "'0011'", "'100.00'", "'00000000250.00'",
        "lpad(shares_outstanding, 14, '0')", "lpad(shares_outstanding div 3, 14, '0')", "100", "''", "'----------'",
        "'0000'")))


def q_feed_brokers(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet")
    return FD.feed_brokers(c.select(_record("B", "concat('C', c_custkey)", "c_name", "c_custkey % 2")))


def q_market_cap_load(spark, sf):
    """Capitalisations with fractions, as the bulk rows have them, loaded into the table's types."""
    from bursa.sources.sinks import load_market_cap
    m = _v(spark, sf, "market_cap")
    raw = m.withColumn("market_capitalization",
                       F.expr("CAST(market_capitalization AS DECIMAL(30,0)) + CAST(month AS DECIMAL(4,0)) * 0.0625"))
    return load_market_cap(raw.withColumn("percentage", F.lit("1.25"))).withColumns(
        {"percentage": F.col("percentage").cast("double")})


def _scratch(spark, name):
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _streamed(spark, df, name, start, chunks=4, time_col="ts"):
    """``df`` as a stream, chunk by chunk: ``start`` makes a query of the source, which goes on
    from its checkpoint after each chunk."""
    path = _scratch(spark, f"{name}-src")

    def go_on():
        start(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 16).parquet(path)).awaitTermination()

    ST.replay(df, path, time_col, chunks, files=16, after=go_on)


def q_stream_daily_ohlc(spark, sf):
    out, checkpoint = _scratch(spark, "daily_ohlc"), _scratch(spark, "ck-daily")

    def start(src):
        stream = ST.daily_ohlc_stream(src).withColumn("bucket_month", F.date_format("bucket", "yyyy-MM"))
        return ST.run_to_table(stream, out, ["security_code", "bucket"], ["bucket_month"], checkpoint)

    _streamed(spark, _v(spark, sf, "trades"), "trades", start)
    return spark.read.parquet(out).drop("bucket_month")


def q_stream_latest_snapshot(spark, sf):
    out, checkpoint = _scratch(spark, "latest"), _scratch(spark, "ck-latest")
    _streamed(spark, _v(spark, sf, "stock_summary"), "summary", lambda src: ST.run_to_table(
        ST.latest_snapshot_stream(src), out, ["security_code"], ["security_code"], checkpoint))
    return spark.read.parquet(out).select(*_v(spark, sf, "stock_summary").columns)


def q_stream_dedupe_trades(spark, sf):
    t = _v(spark, sf, "trades")
    resent = t.where(F.col("board_code") == "NG")
    out, checkpoint = _scratch(spark, "dedup"), _scratch(spark, "ck-dedup")
    _streamed(spark, t.unionByName(resent), "trades-resent", lambda src: (
        ST.dedupe_stream(src).writeStream.format("parquet").outputMode("append")
          .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)))
    return spark.read.parquet(out)


def q_stream_feed_trades(spark, sf):
    """Trades replayed as feed text files in arrival order, ingested by the feed stream."""
    lines = _v(spark, sf, "trades").select("ts", FD.trade_line().alias("value"))
    text_dir = _scratch(spark, "feed-text")
    ST.replay(lines, text_dir, "ts", 4, fmt="text")
    out = _scratch(spark, "feed-out")
    ST.stream_feed(spark, text_dir, out, _scratch(spark, "ck-feed"), max_files=16).awaitTermination()
    from bursa.sources.schemas import read_table
    return read_table(spark, "trades", f"{out}/trades")


def q_stream_top_movers(spark, sf):
    minutes, ranks, checkpoint = _scratch(spark, "minute"), _scratch(spark, "ranks"), _scratch(spark, "ck-minute")
    _streamed(spark, _v(spark, sf, "stock_summary"), "summary-min", lambda src: (
        ST.minute_change_stream(src).writeStream.outputMode("update").foreachBatch(ST.movers_sink(minutes, ranks))
          .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()))
    return spark.read.parquet(ranks).drop("minute_day")


def q_stream_two_feeds(spark, sf):
    """Two streams, each with a checkpoint of its own, into one table."""
    from bursa.sources.schemas import read_table
    out, t = _scratch(spark, "two-feeds"), _v(spark, sf, "trades")
    for half in (0, 1):
        lines = t.where(F.col("trade_no") % 2 == half).select("ts", FD.trade_line().alias("value"))
        text_dir = _scratch(spark, f"half-{half}")
        ST.replay(lines, text_dir, "ts", 2, fmt="text")
        ST.stream_feed(spark, text_dir, out, _scratch(spark, "ck-half")).awaitTermination()
    return read_table(spark, "trades", f"{out}/trades")


def q_stream_eod_resend(spark, sf):
    """Live trades, one in ten lost and one in ten sent twice; hours later all of them again
    with brokers and order numbers, in another stream that begins with no state."""
    t, eod = _v(spark, sf, "trades"), _v(spark, sf, "trades_eod")
    live = t.where(F.col("trade_no") % 10 != 3)
    live = live.unionByName(live.where(F.col("trade_no") % 10 == 7)).select("ts", FD.trade_line().alias("value"))
    out = _scratch(spark, "reconciled")
    for name, lines in (("live", live), ("eod", eod.select("ts", FD.eod_line().alias("value")))):
        text_dir = _scratch(spark, f"{name}-lines")
        ST.replay(lines, text_dir, "ts", 2, fmt="text")
        (ST.feed_source(spark, "text", text_dir).writeStream.foreachBatch(ST.reconcile_sink(out))
           .option("checkpointLocation", _scratch(spark, "ck-reconcile")).trigger(availableNow=True).start()
           .awaitTermination())
    return spark.read.parquet(out).withColumn("trade_date", F.col("trade_date").cast("string")).drop("record")


def q_stream_sideways_late(spark, sf):
    """Daily bars in an order of their own; the state of every day."""
    d = _v(spark, sf, "daily_ohlc")
    late = F.timestamp_add("DAY", F.pmod(F.xxhash64("security_code", "bucket"), F.lit(4)).cast("int"),
                           F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))
    path = _scratch(spark, "late-src")
    ST.replay(d.withColumn("arrival", late), path, "arrival", 3)
    src = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 64).parquet(path)
    daily, state = _scratch(spark, "late-bars"), _scratch(spark, "late-state")
    (src.writeStream.foreachBatch(ST.sideways_state_sink(daily, state, days=60, max_range=SIDEWAYS_RANGE,
                                                         max_volume=SIDEWAYS_VOLUME,
                                                         min_avg_value=HISTORY_MIN_VALUE))
        .option("checkpointLocation", _scratch(spark, "ck-late")).trigger(availableNow=True).start()
        .awaitTermination())
    return SW.read_sideways(spark, state)


def q_stream_sideways_state(spark, sf):
    d = _v(spark, sf, "daily_ohlc")
    daily, state, checkpoint = _scratch(spark, "daily-bars"), _scratch(spark, "state"), _scratch(spark, "ck-state")
    sink = ST.sideways_state_sink(daily, state, days=60, max_range=SIDEWAYS_RANGE, max_volume=SIDEWAYS_VOLUME,
                                  min_avg_value=HISTORY_MIN_VALUE)
    _streamed(spark, d, "daily", lambda src: (
        src.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()),
        chunks=1, time_col="bucket")
    stored = SW.read_sideways(spark, state)
    return stored.where(F.col("trade_date") == stored.select(F.max("trade_date")).scalar())


def q_rsi14_wilder(spark, sf):
    h = _v(spark, sf, "history_ohlc").where(F.col("close").isNotNull()).select("code", "trade_date", "close")
    return with_wilder_rsi(h, "close", "code", "trade_date", 14, "rsi_wilder")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rebound_candidates": q_rebound_candidates,
    "criteria_counts": q_criteria_counts,
    "rebound_detail": q_rebound_detail,
    "rebound_detail_summary": q_rebound_detail_summary,
    "rebound_detail_3b": q_rebound_detail_3b,
    "rebound_strict": q_rebound_strict,
    "rebound_relaxed": q_rebound_relaxed,
    "rebound_backtest": q_rebound_backtest,
    "table_counts": q_table_counts,
    "coverage_summary": q_coverage_summary,
    "coverage_history": q_coverage_history,
    "coverage_today": q_coverage_today,
    "sample_latest": q_sample_latest,
    "latest_date": q_latest_date,
    "date_match": q_date_match,
    "missing_fundamentals": q_missing_fundamentals,
    "fundamentals_coverage": q_fundamentals_coverage,
    "latest_snapshot": q_latest_snapshot,
    "eod_snapshots": q_eod_snapshots,
    "previous_day_merged": q_previous_day_merged,
    "afternoon_trend": q_afternoon_trend,
    "afternoon_counts": q_afternoon_counts,
    "snapshot_counts": q_snapshot_counts,
    "daily_screen": q_daily_screen,
    "daily_screen_backtest": q_daily_screen_backtest,
    "daily_marks": q_daily_marks,
    "ma_coverage": q_ma_coverage,
    "ma5_breakout": q_ma5_breakout,
    "ma5_breakout_all": q_ma5_breakout_all,
    "ma20_swing": q_ma20_swing,
    "ma20_swing_latest": q_ma20_swing_latest,
    "daily_bars": q_daily_bars,
    "daily_ohlc_build": q_daily_ohlc_build,
    "sideways_7d": q_sideways_7d,
    "sideways_7d_all": q_sideways_7d_all,
    "sideways_60d": q_sideways_60d,
    "sideways_60d_all": q_sideways_60d_all,
    "sideways_60d_asof": q_sideways_60d_asof,
    "current_sideways": q_current_sideways,
    "sideways_upsert": q_sideways_upsert,
    "tick_direction": q_tick_direction,
    "trade_tape_summary": q_trade_tape_summary,
    "rebound_asof": q_rebound_asof,
    "rebound_asof_backtest": q_rebound_asof_backtest,
    "top_gainers": q_top_gainers,
    "top_losers": q_top_losers,
    "most_active": q_most_active,
    "book_totals": q_book_totals,
    "key_audit": q_key_audit,
    "null_audit": q_null_audit,
    "swing_spec": q_swing_spec,
    "swing_latest": q_swing_latest,
    "rsi14": q_rsi14,
    "rsi14_wilder": q_rsi14_wilder,
    "feed_trades": q_feed_trades,
    "feed_summary": q_feed_summary,
    "feed_orderbook": q_feed_orderbook,
    "feed_book_summary": q_feed_book_summary,
    "feed_rank_lists": q_feed_rank_lists,
    "feed_rejects": q_feed_rejects,
    "stream_daily_ohlc": q_stream_daily_ohlc,
    "stream_latest_snapshot": q_stream_latest_snapshot,
    "stream_dedupe_trades": q_stream_dedupe_trades,
    "stream_feed_trades": q_stream_feed_trades,
    "stream_top_movers": q_stream_top_movers,
    "stream_sideways_state": q_stream_sideways_state,
    "rebound_strict_loose": q_rebound_strict_loose,
    "rebound_strict_backtest": q_rebound_strict_backtest,
    "avg_volume_daily": q_avg_volume_daily,
    "range_stats": q_range_stats,
    "ma20_swing_last_hit": q_ma20_swing_last_hit,
    "coverage_current_date": q_coverage_current_date,
    "market_cap_load": q_market_cap_load,
    "feed_trades_eod": q_feed_trades_eod,
    "feed_index": q_feed_index,
    "feed_stock_master": q_feed_stock_master,
    "feed_brokers": q_feed_brokers,
    "feed_reject_reasons": q_feed_reject_reasons,
    "feed_conservation": q_feed_conservation,
    "stream_two_feeds": q_stream_two_feeds,
    "stream_eod_resend": q_stream_eod_resend,
    "stream_sideways_late": q_stream_sideways_late,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query (K-07 rebound candidates) on sf0.001."""
    return _present(q_rebound_candidates(spark, SF_SMOKE))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {k: (lambda f: (lambda spark, sf: _present(f(spark, sf))))(f) for k, f in _QUERIES.items()}
    return own | _corpus_queries()


def _corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The corpus operators' queries and the pipeline, where that subpackage is installed."""
    try:
        import corpus_pipeline
        from bursa.llm.queries import QUERIES
    except ImportError:
        return {}
    return QUERIES | {"pipeline": corpus_pipeline.run}


def _corpus_sql() -> dict[str, str]:
    try:
        import corpus_pipeline
        from bursa.llm.queries import ORACLES
    except ImportError:
        return {}
    return ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})


# ---------------------------------------------------------------------------------------
# DuckDB oracle side
# ---------------------------------------------------------------------------------------

def _r(x: str, s: int) -> str:
    """Round a double half away from zero (same IEEE steps as the Spark side)."""
    p = f"CAST({10 ** s} AS DOUBLE)"
    return f"(sign(CAST({x} AS DOUBLE)) * (floor(abs(CAST({x} AS DOUBLE)) * {p} + 0.5) / {p}))"


def _div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _b(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def _latest(src: str, keys: str, order: str, where: str = "TRUE") -> str:
    return (f"(SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) "
            f"AS __rn FROM {src} WHERE {where}) WHERE __rn = 1)")


def _ge(x: str, f, total: str, count: str) -> str:
    return f"(CAST({x} AS DECIMAL(20,2)) * {count} >= {f} * {total} AND {count} > 0)"


def _lt(x: str, f, total: str, count: str) -> str:
    return f"(CAST({x} AS DECIMAL(20,2)) * {count} < {f} * {total} AND {count} > 0)"


def _mark(cond: str, yes="✓", no="✗") -> str:
    return f"CASE WHEN {cond} THEN '{yes}' ELSE '{no}' END"


MAXD = "(SELECT max(data_date) FROM stock_summary)"


def _rebound_flags(min_value: int, cur: str = "current_price", shadow: float = 0.6) -> str:
    """The candle columns and five flags (plus 3b) over a frame with the joined inputs."""
    return f""",
  {_r(_div(cur, 'opening_price'), 4)} AS price_to_open_ratio,
  COALESCE({cur} <= 0.97 * opening_price, false) AS is_down_from_open,
  highest_price - lowest_price AS candle_range,
  {cur} - lowest_price AS lower_shadow,
  CASE WHEN highest_price - lowest_price > 0
       THEN {_r(_div(f'{cur} - lowest_price', 'highest_price - lowest_price'), 4)} ELSE 0.0 END AS lower_shadow_ratio,
  COALESCE({cur} - lowest_price >= {shadow} * (highest_price - lowest_price) AND {cur} > lowest_price, false)
      AS has_long_lower_shadow,
  {_r(_div('trade_volume', _div('vol_sum', 'vol_days')), 4)} AS volume_to_avg_ratio,
  COALESCE(vol_sum IS NOT NULL AND {_ge('trade_volume', 1.5, 'vol_sum', 'vol_days')}, false) AS has_volume_surge,
  COALESCE(vol_sum IS NOT NULL AND {_lt('trade_volume', 1, 'vol_sum', 'vol_days')}, false) AS volume_below_avg,
  COALESCE(trade_value >= {min_value}, false) AS is_liquid,
  {_r(_div('lowest_price', 'previous_low'), 4)} AS low_to_prev_low_ratio,
  COALESCE(previous_low IS NOT NULL AND lowest_price <= 1.02 * previous_low, false) AS is_near_support"""


SCORE5 = ("(CAST(is_down_from_open AS INT) + CAST(has_long_lower_shadow AS INT) + CAST(has_volume_surge AS INT)"
          " + CAST(is_liquid AS INT) + CAST(is_near_support AS INT))")


def _sql_rebound_candidates() -> str:
    v = SUMMARY_MIN_VALUE
    ls = _latest("stock_summary", "security_code", "ts DESC")
    shadow = "(close_price - lowest_price >= 0.6 * (highest_price - lowest_price) AND close_price > lowest_price)"
    return with_views("stock_summary") + f"""
SELECT security_code, {_d('opening_price')} AS opening_price, {_d('highest_price')} AS highest_price,
       {_d('lowest_price')} AS lowest_price, {_d('close_price')} AS close_price, trade_value,
       {_r(_div('close_price', 'opening_price'), 4)} AS price_to_open_ratio,
       {_r(_div('close_price - lowest_price', 'highest_price - lowest_price'), 4)} AS lower_shadow_ratio,
       {_mark('close_price <= 0.97 * opening_price', 'YES', 'NO')} AS down_3pct,
       {_mark(shadow, 'YES', 'NO')} AS long_shadow,
       {_mark(f'trade_value >= {v}', 'YES', 'NO')} AS liquid
FROM {ls} ls
WHERE trade_value >= {v} AND {shadow}
ORDER BY trade_value DESC, security_code
LIMIT 20"""


def _sql_criteria_counts() -> str:
    v = SUMMARY_MIN_VALUE
    ls = _latest("stock_summary", "security_code", "ts DESC")
    return with_views("stock_summary") + f"""
SELECT count(*) AS total_stocks,
  {_b('sum(CASE WHEN close_price <= 0.97 * opening_price THEN 1 ELSE 0 END)')} AS down_3pct_count,
  {_b('sum(CASE WHEN close_price - lowest_price >= 0.6 * (highest_price - lowest_price) AND close_price > lowest_price THEN 1 ELSE 0 END)')} AS long_shadow_count,
  {_b(f'sum(CASE WHEN trade_value >= {v} THEN 1 ELSE 0 END)')} AS liquid_count
FROM {ls} ls WHERE data_date = {MAXD}"""


def _sql_detail_output(with_3b: bool) -> str:
    b3 = f"  {_mark('volume_below_avg')} AS \"3b_VolBelowAvg\",\n" if with_3b else ""
    return f"""
SELECT security_code, data_date, data_time, {_d('current_price')} AS current_price,
  {_d('opening_price')} AS opening_price, {_d('highest_price')} AS highest_price,
  {_d('lowest_price')} AS lowest_price, {_d('previous_low')} AS previous_low,
  trade_volume AS today_volume, trade_value AS today_value,
  {_r(_div('vol_sum', 'vol_days'), 0)} AS avg_volume_20d, {_d('vol_days')} AS avg_days_count,
  price_to_open_ratio, lower_shadow_ratio, volume_to_avg_ratio, low_to_prev_low_ratio,
  {_d('candle_range')} AS candle_range, {_d('lower_shadow')} AS lower_shadow,
  {_mark('is_down_from_open')} AS "1_Down3%", {_mark('has_long_lower_shadow')} AS "2_LongShadow",
  {_mark('has_volume_surge')} AS "3_VolSurge",
{b3}  {_mark('is_liquid')} AS "4_Liquid", {_mark('is_near_support')} AS "5_NearSupport",
  {_b(SCORE5)} AS criteria_met
FROM ca
WHERE has_long_lower_shadow AND is_liquid"""


def _sql_prev_merged(before: str) -> str:
    pds = _latest("stock_summary", "security_code", "data_date DESC, ts DESC",
                  f"data_date < {before} AND lowest_price IS NOT NULL AND trade_volume IS NOT NULL")
    pdh = _latest("history_ohlc", "code", "trade_date DESC",
                  '"close" IS NOT NULL AND low IS NOT NULL AND volume IS NOT NULL')
    return f"""
pds AS (SELECT security_code, lowest_price AS previous_low, trade_volume AS prev_volume FROM {pds} x),
pdh AS (SELECT code AS security_code, low AS previous_low, volume AS prev_volume FROM {pdh} y),
pd AS (SELECT COALESCE(s.security_code, h.security_code) AS security_code,
              COALESCE(s.previous_low, h.previous_low) AS previous_low,
              COALESCE(s.prev_volume, h.prev_volume) AS prev_volume
       FROM pds s FULL OUTER JOIN pdh h ON s.security_code = h.security_code)"""


def _sql_rebound_detail() -> str:
    ls = _latest("stock_summary", "security_code", "ts DESC", f"data_date = {MAXD}")
    return with_views("stock_summary", "history_ohlc") + f""",
{_sql_prev_merged(MAXD)},
av AS (SELECT code AS security_code, sum(volume) AS vol_sum, count(*) AS vol_days FROM history_ohlc
       WHERE volume IS NOT NULL AND trade_date >= (SELECT max(trade_date) FROM history_ohlc) - INTERVAL 30 DAY
       GROUP BY code HAVING count(*) >= 15),
ca AS (SELECT ls.* EXCLUDE (close_price), ls.close_price AS current_price, pd.previous_low, pd.prev_volume,
              av.vol_sum, av.vol_days {_rebound_flags(SUMMARY_MIN_VALUE)}
       FROM {ls} ls LEFT JOIN pd ON ls.security_code = pd.security_code
                    LEFT JOIN av ON ls.security_code = av.security_code)
""" + _sql_detail_output(False)


def _sql_rebound_detail_summary(with_3b: bool) -> str:
    ds = _latest("stock_summary", "security_code, data_date", "ts DESC",
                 "lowest_price IS NOT NULL AND trade_volume IS NOT NULL AND close_price IS NOT NULL")
    ls = _latest("stock_summary", "security_code", "ts DESC", f"data_date = {MAXD}")
    return with_views("stock_summary") + f""",
ds AS (SELECT * FROM {ds} z),
pd AS (SELECT security_code, lowest_price AS previous_low, trade_volume AS prev_volume
       FROM {_latest('ds', 'security_code', 'data_date DESC', f'data_date < {MAXD}')} w),
av AS (SELECT security_code, sum(trade_volume) AS vol_sum, count(DISTINCT data_date) AS vol_days
       FROM ds WHERE data_date < {MAXD} GROUP BY security_code HAVING count(DISTINCT data_date) >= {MIN_DAYS}),
ca AS (SELECT ls.* EXCLUDE (close_price), ls.close_price AS current_price, pd.previous_low, pd.prev_volume,
              av.vol_sum, av.vol_days {_rebound_flags(SUMMARY_MIN_VALUE)}
       FROM {ls} ls LEFT JOIN pd ON ls.security_code = pd.security_code
                    LEFT JOIN av ON ls.security_code = av.security_code)
""" + _sql_detail_output(with_3b)


def _sql_rebound_strict(k: int, shadow: float = 0.6) -> str:
    ls = _latest("stock_summary", "security_code", "ts DESC", f"data_date = {MAXD}")
    cond = ("is_down_from_open AND has_long_lower_shadow AND has_volume_surge AND is_liquid AND is_near_support"
            if k >= 5 else f"{SCORE5} >= {k}")
    return with_views("stock_summary", "history_ohlc") + f""",
{_sql_prev_merged(MAXD)},
av AS (SELECT code AS security_code, sum(volume) AS vol_sum, count(*) AS vol_days FROM history_ohlc
       WHERE volume IS NOT NULL AND trade_date >= (SELECT max(trade_date) FROM history_ohlc) - INTERVAL 30 DAY
       GROUP BY code HAVING count(*) >= {MIN_DAYS}),
ca AS (SELECT ls.* EXCLUDE (close_price), ls.close_price AS current_price, pd.previous_low, pd.prev_volume,
              av.vol_sum, av.vol_days {_rebound_flags(SUMMARY_MIN_VALUE, shadow=shadow)}
       FROM {ls} ls JOIN pd ON ls.security_code = pd.security_code
                    JOIN av ON ls.security_code = av.security_code)
SELECT security_code, {_d('current_price')} AS current_price, {_d('opening_price')} AS opening_price,
  {_d('highest_price')} AS highest_price, {_d('lowest_price')} AS lowest_price,
  {_d('previous_low')} AS previous_low, data_time AS latest_time, trade_volume AS today_volume,
  trade_value AS today_value, {_div('vol_sum', 'vol_days')} AS avg_volume_20d,
  price_to_open_ratio, lower_shadow_ratio, volume_to_avg_ratio, low_to_prev_low_ratio,
  {_d('candle_range')} AS candle_range, {_d('lower_shadow')} AS lower_shadow,
  is_down_from_open AS "✓_down_3pct", has_long_lower_shadow AS "✓_long_shadow",
  has_volume_surge AS "✓_volume_surge", is_liquid AS "✓_liquid", is_near_support AS "✓_near_support",
  {_b(SCORE5)} AS criteria_met_count
FROM ca WHERE {cond}"""


MAXH = "(SELECT max(trade_date) FROM history_ohlc)"
SUMMARY_COLS = ("data_date, data_time, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, security_code, board_code, "
                "CAST(opening_price AS DOUBLE) AS opening_price, CAST(highest_price AS DOUBLE) AS highest_price, "
                "CAST(lowest_price AS DOUBLE) AS lowest_price, CAST(close_price AS DOUBLE) AS close_price, "
                "trade_volume, trade_value, trade_frequency, CAST(previous_price AS DOUBLE) AS previous_price")


def _sql_rebound_backtest(k: int = 4) -> str:
    ds = _latest("stock_summary", "security_code, data_date", "ts DESC",
                 "lowest_price IS NOT NULL AND trade_volume IS NOT NULL AND close_price IS NOT NULL")
    return with_views("stock_summary") + f""",
d0 AS (SELECT *, lag(lowest_price) OVER w AS previous_low, lag(trade_volume) OVER w AS prev_volume,
              sum(trade_volume) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS vs,
              count(data_date) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS vn
       FROM {ds} x WINDOW w AS (PARTITION BY security_code ORDER BY data_date)),
d AS (SELECT * EXCLUDE (close_price, vs, vn), close_price AS current_price,
             CASE WHEN vn >= {MIN_DAYS} THEN vs END AS vol_sum, CASE WHEN vn >= {MIN_DAYS} THEN vn END AS vol_days
      FROM d0),
ca AS (SELECT * {_rebound_flags(SUMMARY_MIN_VALUE)} FROM d)
SELECT security_code, data_date, {_d('current_price')} AS current_price, {_d('opening_price')} AS opening_price,
       {_d('highest_price')} AS highest_price, {_d('lowest_price')} AS lowest_price,
       {_d('previous_low')} AS previous_low, trade_volume AS today_volume, trade_value AS today_value,
       {_r(_div('vol_sum', 'vol_days'), 0)} AS avg_volume_20d, price_to_open_ratio, lower_shadow_ratio,
       volume_to_avg_ratio, low_to_prev_low_ratio, is_down_from_open, has_long_lower_shadow, has_volume_surge,
       is_liquid, is_near_support, {_b(SCORE5)} AS criteria_met
FROM ca WHERE {SCORE5} >= {k}"""


def _sql_daily_stats(columns: str) -> str:
    ds = _latest("stock_summary", "security_code, data_date", "ts DESC", f"data_date < {MAXD}")
    return with_views("stock_summary") + f"""
SELECT security_code, {columns} FROM {ds} x GROUP BY security_code HAVING count(DISTINCT data_date) >= {MIN_DAYS}"""


def _sql_ma20_swing_last_hit() -> str:
    text = _sql_ma20_swing(False)
    return f"SELECT * FROM ({text}) hits WHERE trade_date = (SELECT max(trade_date) FROM ({text}) every_hit)"


def _sql_coverage_current_date() -> str:
    return with_views("stock_summary") + f"""
SELECT 'today_stock_summary' AS table_name, count(DISTINCT security_code) AS stock_count, count(*) AS total_records
FROM (SELECT security_code, strptime(data_date, '%Y%m%d')::DATE
             + CAST(current_date - strptime({MAXD}, '%Y%m%d')::DATE AS INTEGER) AS day FROM stock_summary)
WHERE day = current_date"""


def _sql_table_counts() -> str:
    return with_views("orderbook", "stock_summary") + """
SELECT 'orderbook' AS table_name, count(ts) AS row_count FROM orderbook
UNION ALL SELECT 'trades', count(ts) FROM trades
UNION ALL SELECT 'stock_summary', count(ts) FROM stock_summary"""


def _sql_coverage(view: str, code: str, day: str, date_fmt: bool) -> str:
    lo = f"strftime(min({day}), '%Y-%m-%d')" if date_fmt else f"min({day})"
    hi = f"strftime(max({day}), '%Y-%m-%d')" if date_fmt else f"max({day})"
    return with_views(view) + f"""
SELECT '{view}' AS table_name, count(DISTINCT {code}) AS stock_count, {lo} AS earliest_date,
       {hi} AS latest_date, count(*) AS total_records FROM {view}"""


def _sql_coverage_today() -> str:
    return with_views("stock_summary") + f"""
SELECT 'today_stock_summary' AS table_name, count(DISTINCT security_code) AS stock_count,
       count(*) AS total_records FROM stock_summary WHERE data_date = {MAXD}"""


def _sql_sample_latest() -> str:
    return with_views("stock_summary") + f"""
SELECT security_code, data_date, data_time, {_d('opening_price')} AS opening_price,
       {_d('highest_price')} AS highest_price, {_d('lowest_price')} AS lowest_price,
       {_d('close_price')} AS close_price, trade_volume, trade_value
FROM stock_summary WHERE data_date = {MAXD}
ORDER BY trade_value DESC, security_code, ts DESC LIMIT 10"""


def _sql_latest_date() -> str:
    return with_views("stock_summary") + """
SELECT 'Latest stock_summary date' AS info, max(data_date) AS latest_date,
       count(DISTINCT security_code) AS stock_count FROM stock_summary"""


def _sql_date_match() -> str:
    return with_views("stock_summary") + f"""
SELECT 'Current date match' AS info, strftime(strptime({MAXD}, '%Y%m%d'), '%Y-%m-%d') AS current_date,
       {MAXD} AS formatted_current_date, count(DISTINCT security_code) AS stock_count_today
FROM stock_summary WHERE data_date = {MAXD}"""


def _sql_missing_fundamentals() -> str:
    return with_views("history_ohlc", "stock_fundamentals") + f"""
SELECT ho.code AS security_code, count(DISTINCT ho.trade_date) AS days_of_data,
       strftime(max(ho.trade_date), '%Y-%m-%d') AS latest_date, {_d('max(ho."close")')} AS latest_close_price,
       CAST(sum(ho."value") AS DOUBLE) / CAST(count(ho."value") AS DOUBLE) AS avg_daily_value,
       'MISSING - Add to stock_fundamentals table' AS status
FROM history_ohlc ho LEFT JOIN stock_fundamentals sf ON ho.code = sf.security_code
WHERE sf.security_code IS NULL AND ho.trade_date >= {MAXH} - INTERVAL 30 DAY AND ho."value" > {HISTORY_MIN_VALUE}
GROUP BY ho.code ORDER BY avg_daily_value DESC, security_code LIMIT 50"""


def _sql_fundamentals_coverage() -> str:
    return with_views("history_ohlc", "stock_fundamentals") + f"""
SELECT count(DISTINCT ho.code) AS total_stocks_in_history,
       count(DISTINCT sf.security_code) AS stocks_with_fundamentals,
       count(DISTINCT ho.code) - count(DISTINCT sf.security_code) AS missing_fundamentals
FROM history_ohlc ho LEFT JOIN stock_fundamentals sf ON ho.code = sf.security_code
WHERE ho.trade_date >= {MAXH} - INTERVAL 30 DAY"""


def _sql_latest_snapshot() -> str:
    return with_views("stock_summary") + f"""
SELECT {SUMMARY_COLS} FROM {_latest('stock_summary', 'security_code', 'ts DESC')} x"""


def _sql_eod_snapshots() -> str:
    return with_views("stock_summary") + f"""
SELECT {SUMMARY_COLS} FROM {_latest('stock_summary', 'security_code, data_date', 'ts DESC')} x"""


def _sql_previous_day_merged() -> str:
    return with_views("stock_summary", "history_ohlc") + f""",
{_sql_prev_merged(MAXD)}
SELECT security_code, {_d('previous_low')} AS previous_low, prev_volume FROM pd"""


MOD = "(hour(ts) * 60 + minute(ts))"


def _sql_avt_cte() -> str:
    return f"""avt AS (
  SELECT security_code,
         max(CASE WHEN {MOD} BETWEEN 870 AND 900 THEN trade_volume END) AS volume_1430_1500,
         max(CASE WHEN {MOD} BETWEEN 900 AND 930 THEN trade_volume END) AS volume_1500_1530,
         max(CASE WHEN {MOD} >= 930 THEN trade_volume END) AS volume_1530_close
  FROM stock_summary WHERE data_date = {MAXD} AND {MOD} >= 870 GROUP BY security_code),
avt2 AS (SELECT *, COALESCE(volume_1530_close > volume_1500_1530 AND volume_1500_1530 > volume_1430_1500, false)
                    AS is_volume_increasing FROM avt)"""


def _sql_afternoon_trend() -> str:
    return with_views("stock_summary") + ", " + _sql_avt_cte() + """
SELECT security_code, CAST(volume_1430_1500 AS DOUBLE) AS volume_1430_1500,
       CAST(volume_1500_1530 AS DOUBLE) AS volume_1500_1530, CAST(volume_1530_close AS DOUBLE) AS volume_1530_close,
       is_volume_increasing FROM avt2"""


def _sql_afternoon_counts() -> str:
    return with_views("stock_summary") + ", " + _sql_avt_cte() + """
SELECT 'Afternoon volume trend' AS info, count(*) AS total_stocks,
       CAST(sum(CASE WHEN is_volume_increasing THEN 1 ELSE 0 END) AS BIGINT) AS stocks_with_increasing_volume
FROM avt2"""


def _ls_on_max() -> str:
    return _latest("stock_summary", "security_code", "ts DESC", f"data_date = {MAXD}")


def _sql_snapshot_counts() -> str:
    return with_views("stock_summary") + f"""
SELECT 'Latest snapshot' AS info, count(*) AS total_stocks, max(data_date) AS data_date,
  {_b('sum(CASE WHEN close_price >= opening_price THEN 1 ELSE 0 END)')} AS green_candles,
  {_b('sum(CASE WHEN close_price >= 1.05 * previous_price THEN 1 ELSE 0 END)')} AS up_5pct,
  {_b(f'sum(CASE WHEN trade_value > {SUMMARY_MIN_VALUE} THEN 1 ELSE 0 END)')} AS liquid_stocks
FROM {_ls_on_max()} x"""


def _pct(a: str, b: str) -> str:
    return _r(f"CAST({a} - {b} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0) * CAST(100 AS DOUBLE)", 2)


def _sql_daily_screen() -> str:
    ds = _latest("stock_summary", "security_code, data_date", "ts DESC",
                 "close_price IS NOT NULL AND trade_volume IS NOT NULL")
    return with_views("stock_summary") + f""", {_sql_avt_cte()},
m5 AS (SELECT security_code, data_date, sum(close_price) OVER w AS ma5_sum, count(close_price) OVER w AS ma5_n,
              lag(trade_volume) OVER (PARTITION BY security_code ORDER BY data_date) AS yesterday_volume
       FROM {ds} d WINDOW w AS (PARTITION BY security_code ORDER BY data_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
lm AS (SELECT * FROM {_latest('m5', 'security_code', 'data_date DESC')} q)
SELECT ls.security_code, {_d('ls.close_price')} AS current_price, {_d('ls.opening_price')} AS opening_price,
       {_d('ls.previous_price')} AS previous_price, {_div('lm.ma5_sum', 'lm.ma5_n')} AS ma5,
       ls.trade_volume, ls.trade_value, {_pct('ls.close_price', 'ls.previous_price')} AS pct_change
FROM {_ls_on_max()} ls JOIN lm ON ls.security_code = lm.security_code
JOIN avt2 ON ls.security_code = avt2.security_code
WHERE {_ge('ls.close_price', 1, 'lm.ma5_sum', 'lm.ma5_n')} AND ls.close_price >= 1.05 * ls.previous_price
  AND ls.close_price >= ls.opening_price AND ls.trade_volume >= 1.20 * lm.yesterday_volume
  AND ls.trade_value > {SUMMARY_MIN_VALUE} AND avt2.is_volume_increasing"""


def _sql_daily_screen_backtest() -> str:
    ds = _latest("stock_summary", "security_code, data_date", "ts DESC",
                 "close_price IS NOT NULL AND trade_volume IS NOT NULL")
    return with_views("stock_summary") + f""",
m5 AS (SELECT *, sum(close_price) OVER w AS ma5_sum, count(close_price) OVER w AS ma5_n,
              lag(trade_volume) OVER (PARTITION BY security_code ORDER BY data_date) AS yesterday_volume
       FROM {ds} d WINDOW w AS (PARTITION BY security_code ORDER BY data_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
tr AS (SELECT security_code, data_date,
              COALESCE(max(CASE WHEN {MOD} >= 930 THEN trade_volume END)
                         > max(CASE WHEN {MOD} BETWEEN 900 AND 930 THEN trade_volume END)
                       AND max(CASE WHEN {MOD} BETWEEN 900 AND 930 THEN trade_volume END)
                         > max(CASE WHEN {MOD} BETWEEN 870 AND 900 THEN trade_volume END), false)
                  AS is_volume_increasing
       FROM stock_summary WHERE {MOD} >= 870 GROUP BY security_code, data_date)
SELECT m5.security_code, m5.data_date, {_d('close_price')} AS current_price, {_d('opening_price')} AS opening_price,
       {_d('previous_price')} AS previous_price, {_div('ma5_sum', 'ma5_n')} AS ma5, trade_volume, trade_value,
       {_pct('close_price', 'previous_price')} AS pct_change
FROM m5 JOIN tr ON m5.security_code = tr.security_code AND m5.data_date = tr.data_date
WHERE {_ge('close_price', 1, 'ma5_sum', 'ma5_n')} AND close_price >= 1.05 * previous_price
  AND close_price >= opening_price AND trade_volume >= 1.20 * yesterday_volume
  AND trade_value > {SUMMARY_MIN_VALUE} AND is_volume_increasing"""


def _sql_daily_marks() -> str:
    m5 = f"""(SELECT code, trade_date, volume, sum("close") OVER w AS ma5_sum, count("close") OVER w AS ma5_n
          FROM history_ohlc WHERE "close" IS NOT NULL AND volume IS NOT NULL
          WINDOW w AS (PARTITION BY code ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))"""
    return with_views("stock_summary", "history_ohlc") + f""",
lm AS (SELECT code AS security_code, ma5_sum, ma5_n, volume AS yesterday_volume
       FROM {_latest(m5, 'code', 'trade_date DESC')} q)
SELECT ls.security_code, ls.data_date, {_d('ls.close_price')} AS current_price,
  {_d('ls.opening_price')} AS opening_price, {_d('ls.previous_price')} AS previous_price,
  {_div('lm.ma5_sum', 'lm.ma5_n')} AS ma5, ls.trade_volume AS today_volume,
  CAST(lm.yesterday_volume AS DOUBLE) AS yesterday_volume,
  ls.trade_value AS today_value,
  {_mark(_ge('ls.close_price', 1, 'lm.ma5_sum', 'lm.ma5_n'))} AS above_ma5,
  {_mark('ls.close_price >= 1.05 * ls.previous_price')} AS up_5pct,
  {_mark('ls.close_price >= ls.opening_price')} AS green,
  {_mark('ls.trade_volume >= 1.20 * lm.yesterday_volume')} AS vol_up,
  {_mark(f'ls.trade_value > {SUMMARY_MIN_VALUE}')} AS liquid
FROM {_ls_on_max()} ls LEFT JOIN lm ON ls.security_code = lm.security_code
ORDER BY ls.trade_value DESC, ls.security_code LIMIT 10"""


def _sql_ma_coverage() -> str:
    return with_views("history_ohlc") + """
SELECT 'MA5 stocks with 5 days data' AS info, count(DISTINCT code) AS stock_count,
       strftime(max(trade_date), '%Y-%m-%d') AS latest_ma5_date
FROM (SELECT code, trade_date, count(*) OVER (PARTITION BY code ORDER BY trade_date
             ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS days_count
      FROM history_ohlc WHERE "close" IS NOT NULL AND volume IS NOT NULL)
WHERE days_count = 5"""


def _sql_ma5_breakout(latest: bool) -> str:
    day = f"AND trade_date = {MAXH}" if latest else ""
    return with_views("history_ohlc") + f""",
b AS (SELECT *, sum("close") OVER w AS ma5_sum, count("close") OVER w AS ma5_n,
             lag("close") OVER (PARTITION BY code ORDER BY trade_date) AS prev_close,
             lag(volume) OVER (PARTITION BY code ORDER BY trade_date) AS prev_volume
      FROM history_ohlc WINDOW w AS (PARTITION BY code ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT code AS symbol, strftime(trade_date, '%Y-%m-%d') AS trade_date, {_d('"open"')} AS "open",
       {_d('"close"')} AS "close", {_d('high')} AS high, {_d('low')} AS low, volume, "value",
       {_div('ma5_sum', 'ma5_n')} AS ma5, {_d('prev_close')} AS prev_close, prev_volume
FROM b
WHERE (CAST("close" AS DECIMAL(20,2)) * ma5_n > ma5_sum AND ma5_n > 0) AND "close" >= prev_close * 1.05
  AND "close" >= "open" AND volume >= prev_volume * 0.20 AND "value" > {HISTORY_MIN_VALUE} {day}"""


def _sql_ma20_swing(latest: bool) -> str:
    day = (f"AND trade_date = (SELECT max(trade_date) FROM history_ohlc WHERE \"close\" IS NOT NULL "
           f"AND volume IS NOT NULL AND \"value\" IS NOT NULL)") if latest else ""
    pma, vma = _div("pma_sum", "pma_n"), _div("vma_sum", "vma_n")
    return with_views("history_ohlc") + f""",
m AS (SELECT *, sum("close") OVER w AS pma_sum, count("close") OVER w AS pma_n,
             sum(volume) OVER w AS vma_sum, count(volume) OVER w AS vma_n,
             lag(volume) OVER (PARTITION BY code ORDER BY trade_date) AS previous_volume,
             count(*) OVER w AS days_count
      FROM history_ohlc WHERE "close" IS NOT NULL AND volume IS NOT NULL AND "value" IS NOT NULL
      WINDOW w AS (PARTITION BY code ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT strftime(trade_date, '%Y-%m-%d') AS trade_date, code AS security_code, {_d('"close"')} AS price,
       volume, "value", freq AS frequency, {_r(pma, 2)} AS price_ma20, {_r(vma, 0)} AS volume_ma20,
       previous_volume, {_r(_div('"close"', pma), 4)} AS price_to_ma20_ratio,
       {_r(_div('volume', 'previous_volume'), 4)} AS volume_to_previous_ratio,
       {_r(_div('volume', vma), 4)} AS volume_to_ma20_ratio
FROM m
WHERE days_count = 20 AND "value" >= {HISTORY_MIN_VALUE} AND "close" > 100
  AND {_ge('"close"', 1, 'pma_sum', 'pma_n')} AND {_ge('"close"', 0.97, 'pma_sum', 'pma_n')}
  AND (CAST("close" AS DECIMAL(20,2)) * pma_n <= 1.03 * pma_sum AND pma_n > 0)
  AND previous_volume IS NOT NULL AND volume >= 1.30 * previous_volume
  AND {_ge('volume', 1.50, 'vma_sum', 'vma_n')} {day}"""


BARS = """bars AS (SELECT security_code, CAST(ts AS DATE) AS trade_date, arg_min(opening_price, ts) AS "open",
                max(highest_price) AS high, min(lowest_price) AS low, arg_max(close_price, ts) AS "close",
                sum(trade_volume) AS volume, sum(trade_value) AS "value"
         FROM stock_summary GROUP BY 1, 2)"""


def _sql_daily_bars() -> str:
    return with_views("stock_summary") + ", " + BARS + """
SELECT security_code, strftime(trade_date, '%Y-%m-%d') AS trade_date, CAST("open" AS DOUBLE) AS "open",
       CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST("close" AS DOUBLE) AS "close",
       CAST(volume AS DOUBLE) AS volume, CAST("value" AS DOUBLE) AS "value" FROM bars"""


def _sql_daily_ohlc_build() -> str:
    return with_views("stock_summary") + """
SELECT strftime(CAST(CAST(ts AS DATE) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS bucket, security_code,
       CAST(arg_min(opening_price, ts) AS DOUBLE) AS "open", CAST(max(highest_price) AS DOUBLE) AS high,
       CAST(min(lowest_price) AS DOUBLE) AS low, CAST(arg_max(close_price, ts) AS DOUBLE) AS "close",
       CAST(arg_max(trade_volume, ts) AS BIGINT) AS volume, CAST(arg_max(trade_value, ts) AS BIGINT) AS "value"
FROM stock_summary GROUP BY security_code, CAST(ts AS DATE)"""


def _roll_cols() -> str:
    return ('max("close") OVER w AS mx, min("close") OVER w AS mn, sum(volume) OVER w AS vsum, '
            'count(volume) OVER w AS vn, sum("value") OVER w AS asum, count("value") OVER w AS an')


def _sql_sideways_7d(last: bool) -> str:
    day = "AND trade_date = (SELECT max(trade_date) FROM bars)" if last else ""
    return with_views("stock_summary") + ", " + BARS + f""",
r AS (SELECT *, {_roll_cols()} FROM bars
      WINDOW w AS (PARTITION BY security_code ORDER BY trade_date
                   RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
SELECT security_code AS symbol, strftime(trade_date, '%Y-%m-%d') AS trade_date,
       CAST(mx - mn AS DOUBLE) / CAST(mn AS DOUBLE) AS range_ratio,
       CAST(volume AS DOUBLE) / (CAST(vsum AS DOUBLE) / CAST(vn AS DOUBLE)) AS volume_ratio,
       CAST(asum AS DOUBLE) / CAST(an AS DOUBLE) AS avg_value_prev
FROM r WHERE mn <> 0 AND mx - mn < {SIDEWAYS_RANGE} * mn AND vsum <> 0 AND volume * vn < {SIDEWAYS_VOLUME} * vsum
  AND an > 0 AND asum > {SUMMARY_MIN_VALUE} * an {day}"""


def _sql_state_cte(src: str = "daily_ohlc") -> str:
    return f"""r AS (SELECT *, CAST(bucket AS DATE) AS trade_date, {_roll_cols()} FROM {src}
      WINDOW w AS (PARTITION BY security_code ORDER BY bucket
                   RANGE BETWEEN INTERVAL 60 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)),
st AS (SELECT security_code AS symbol, trade_date,
       CASE WHEN mn > 0 THEN CAST(mx - mn AS DOUBLE) / CAST(mn AS DOUBLE) ELSE 0.0 END AS range_ratio,
       CASE WHEN vsum > 0 THEN CAST(volume AS DOUBLE) / (CAST(vsum AS DOUBLE) / CAST(vn AS DOUBLE)) ELSE 0.0 END
           AS volume_ratio,
       COALESCE((CASE WHEN mn > 0 THEN mx - mn < {SIDEWAYS_RANGE} * mn ELSE true END)
                AND (CASE WHEN vsum > 0 THEN volume * vn < {SIDEWAYS_VOLUME} * vsum ELSE true END)
                AND (CASE WHEN an > 0 THEN asum > {HISTORY_MIN_VALUE} * an END), false) AS is_sideways
       FROM r)"""


def _sql_sideways_60d(last: bool) -> str:
    day = "WHERE trade_date = (SELECT CAST(max(bucket) AS DATE) FROM daily_ohlc)" if last else ""
    return with_views("daily_ohlc") + ", " + _sql_state_cte() + f"""
SELECT symbol, strftime(trade_date, '%Y-%m-%d') AS trade_date, range_ratio, volume_ratio, is_sideways
FROM st {day}"""


def _sql_sideways_60d_asof() -> str:
    return with_views("daily_ohlc") + """,
past AS (SELECT * FROM daily_ohlc
         WHERE CAST(bucket AS DATE) <= (SELECT CAST(max(bucket) AS DATE) - INTERVAL 365 DAY FROM daily_ohlc)), """ + \
        _sql_state_cte("past") + """
SELECT symbol, strftime(trade_date, '%Y-%m-%d') AS trade_date, range_ratio, volume_ratio, is_sideways
FROM st WHERE trade_date = (SELECT max(trade_date) FROM st)"""


def _sql_current_sideways() -> str:
    return with_views("daily_ohlc") + ", " + _sql_state_cte() + """
SELECT symbol, strftime(trade_date, '%Y-%m-%d') AS trade_date, range_ratio, volume_ratio, is_sideways
FROM st WHERE trade_date = (SELECT max(trade_date) FROM st) AND is_sideways"""


TICKS = """tk AS (SELECT *, CAST(ts AS DATE) AS trade_day,
                lag(price) OVER (PARTITION BY security_code, CAST(ts AS DATE) ORDER BY ts, trade_no) AS prev_price
         FROM trades),
tk2 AS (SELECT *, COALESCE(price > prev_price, false) AS is_price_up,
               COALESCE(price < prev_price, false) AS is_price_down FROM tk)"""


def _tape_aggs(prefix: str = "") -> str:
    p = prefix
    hours = ("(epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(1000000 AS DOUBLE) / CAST(3600 AS DOUBLE)")
    return f"""
  {_r('CAST(max(price) - min(price) AS DOUBLE) / NULLIF(CAST(min(price) AS DOUBLE), 0) * CAST(100 AS DOUBLE)', 2)}
      AS {p}trade_price_momentum_pct,
  count(*) AS {p}total_trade_count,
  {_r('CAST(sum(price * volume) AS DOUBLE) / NULLIF(CAST(sum(volume) AS DOUBLE), 0)', 2)} AS {p}vwap_price,
  CAST(sum(CASE WHEN is_price_up THEN volume ELSE 0 END) AS BIGINT) AS {p}aggressive_buy_volume,
  CAST(sum(volume) AS BIGINT) AS {p}total_trade_volume,
  {_r(f'CAST(count(*) AS DOUBLE) / NULLIF({hours}, 0)', 2)} AS {p}trades_per_hour,
  CAST(sum(CASE WHEN is_price_up THEN 1 ELSE 0 END) - sum(CASE WHEN is_price_down THEN 1 ELSE 0 END) AS BIGINT)
      AS {p}price_direction_score,
  CAST(sum(CASE WHEN volume >= 1000000 THEN volume ELSE 0 END) AS BIGINT) AS {p}large_trade_volume"""


def _sql_tick_direction() -> str:
    return with_views("trades") + ", " + TICKS + """
SELECT trade_no, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, security_code, CAST(price AS DOUBLE) AS price,
       volume, strftime(trade_day, '%Y-%m-%d') AS trade_day, CAST(prev_price AS DOUBLE) AS prev_price,
       is_price_up, is_price_down FROM tk2"""


def _sql_trade_tape_summary() -> str:
    return with_views("trades") + ", " + TICKS + f"""
SELECT security_code, strftime(trade_day, '%Y-%m-%d') AS trade_day, {_tape_aggs()}
FROM tk2 GROUP BY security_code, trade_day HAVING count(*) >= {MIN_TRADES}"""


def _asof_flags6() -> str:
    return f""",
  COALESCE(tma_trade_price_momentum_pct >= 2.0, false) AS has_trade_flow_momentum,
  COALESCE(tma_total_trade_volume > 0 AND tma_aggressive_buy_volume >= 0.6 * tma_total_trade_volume, false)
      AS has_aggressive_buying,
  COALESCE(vol_sum IS NOT NULL AND {_lt('trade_volume', 3, 'vol_sum', 'vol_days')}, false) AS volume_not_overheated,
  COALESCE(previous_price IS NOT NULL AND current_price > previous_price * 1.03, false) AS price_strengthening,
  COALESCE(min_price_20d IS NOT NULL AND current_price <= min_price_20d * 1.10, false) AS not_overextended,
  COALESCE(max_price_20d IS NOT NULL AND current_price >= max_price_20d * 0.95, false) AS not_in_downtrend"""


def _asof_select() -> str:
    score11 = ("(" + " + ".join(f"CAST({f} AS INT)" for f in AO.ASOF_FLAGS) + ")")
    return f"""SELECT security_code, data_date, data_time, {_d('current_price')} AS current_price,
  {_d('opening_price')} AS opening_price, {_d('highest_price')} AS highest_price,
  {_d('lowest_price')} AS lowest_price, {_d('previous_low')} AS previous_low,
  {_d('previous_price')} AS previous_price, trade_volume AS today_volume, trade_value AS today_value,
  {_r(_div('vol_sum', 'vol_days'), 0)} AS avg_volume_20d, {_d('vol_days')} AS avg_days_count,
  COALESCE(tma_total_trade_count, 0) AS total_trade_count,
  COALESCE(tma_total_trade_volume, 0) AS trade_executed_volume,
  COALESCE(tma_trades_per_hour, 0.0) AS trades_per_hour,
  COALESCE(tma_trade_price_momentum_pct, 0.0) AS trade_price_momentum_pct,
  COALESCE(tma_vwap_price, CAST(current_price AS DOUBLE)) AS vwap_price,
  COALESCE(tma_aggressive_buy_volume, 0) AS aggressive_buy_volume,
  COALESCE(tma_price_direction_score, 0) AS price_direction_score,
  COALESCE(tma_large_trade_volume, 0) AS large_trade_volume,
  price_to_open_ratio, lower_shadow_ratio, volume_to_avg_ratio, low_to_prev_low_ratio,
  {_pct('current_price', 'previous_price')} AS price_change_pct,
  {_pct('current_price', 'min_price_20d')} AS price_increase_20d_pct,
  {_r('CAST(max_price_20d - current_price AS DOUBLE) / NULLIF(CAST(max_price_20d AS DOUBLE), 0) * CAST(100 AS DOUBLE)', 2)}
      AS price_decrease_from_high_pct,
  {_d('max_price_20d')} AS max_price_20d, {_d('min_price_20d')} AS min_price_20d,
  {_d('candle_range')} AS candle_range, {_d('lower_shadow')} AS lower_shadow,
  {_mark('is_down_from_open')} AS "1_Down3%", {_mark('has_long_lower_shadow')} AS "2_LongShadow",
  {_mark('has_volume_surge')} AS "3_VolSurge", {_mark('volume_below_avg')} AS "3b_VolBelowAvg",
  {_mark('is_liquid')} AS "4_Liquid", {_mark('is_near_support')} AS "5_NearSupport",
  {_mark('has_trade_flow_momentum')} AS "6_TradeMomentum", {_mark('has_aggressive_buying')} AS "7_AggressiveBuy",
  {_mark('volume_not_overheated')} AS "8_NotOverheated", {_mark('price_strengthening')} AS "9_Price>3%",
  {_mark('not_overextended')} AS "11_NotExtended<10%", {_mark('not_in_downtrend')} AS "12_NotDown>5%",
  {_b(score11)} AS total_criteria_met
"""


def _sql_rebound_asof() -> str:
    day_txt = "(SELECT strftime(d, '%Y%m%d') FROM mx)"
    lo_txt = "(SELECT strftime(d - INTERVAL 20 DAY, '%Y%m%d') FROM mx)"
    ds = _latest("stock_summary", "security_code, data_date", "ts DESC",
                 f"board_code = 'RG' AND lowest_price IS NOT NULL AND trade_volume IS NOT NULL "
                 f"AND close_price IS NOT NULL AND data_date >= {lo_txt} AND data_date <= {day_txt}")
    ls = _latest("stock_summary", "security_code", "ts DESC", f"board_code = 'RG' AND data_date = {day_txt}")
    flags6 = f""",
  COALESCE(tma_trade_price_momentum_pct >= 2.0, false) AS has_trade_flow_momentum,
  COALESCE(tma_total_trade_volume > 0 AND tma_aggressive_buy_volume >= 0.6 * tma_total_trade_volume, false)
      AS has_aggressive_buying,
  COALESCE(vol_sum IS NOT NULL AND {_lt('trade_volume', 3, 'vol_sum', 'vol_days')}, false) AS volume_not_overheated,
  COALESCE(previous_price IS NOT NULL AND current_price > previous_price * 1.03, false) AS price_strengthening,
  COALESCE(min_price_20d IS NOT NULL AND current_price <= min_price_20d * 1.10, false) AS not_overextended,
  COALESCE(max_price_20d IS NOT NULL AND current_price >= max_price_20d * 0.95, false) AS not_in_downtrend"""
    score11 = ("(" + " + ".join(f"CAST({f} AS INT)" for f in AO.ASOF_FLAGS) + ")")
    return with_views("stock_summary") + f""",
mx AS (SELECT CAST(strptime(max(data_date), '%Y%m%d') AS DATE) AS d FROM stock_summary),
ds AS (SELECT * FROM {ds} a),
pd AS (SELECT security_code, lowest_price AS previous_low, trade_volume AS prev_volume
       FROM {_latest('ds', 'security_code', 'data_date DESC', f'data_date < {day_txt}')} b),
av AS (SELECT security_code, sum(trade_volume) AS vol_sum, max(close_price) AS max_price_20d,
              min(close_price) AS min_price_20d, count(DISTINCT data_date) AS vol_days
       FROM ds WHERE data_date < {day_txt} GROUP BY security_code),
ls AS (SELECT * FROM {ls} c),
tk AS (SELECT *, lag(price) OVER (PARTITION BY security_code ORDER BY ts, trade_no) AS prev_price
       FROM trades WHERE CAST(ts AS DATE) = (SELECT d FROM mx)
         AND security_code IN (SELECT security_code FROM ls)),
tk2 AS (SELECT *, COALESCE(price > prev_price, false) AS is_price_up,
               COALESCE(price < prev_price, false) AS is_price_down FROM tk),
tma AS (SELECT security_code AS tma_code, {_tape_aggs('tma_')}
        FROM tk2 GROUP BY security_code HAVING count(*) >= {MIN_TRADES}),
ca0 AS (SELECT ls.* EXCLUDE (close_price), ls.close_price AS current_price, pd.previous_low, pd.prev_volume,
               av.vol_sum, av.vol_days, av.max_price_20d, av.min_price_20d, tma.*
        FROM ls LEFT JOIN pd ON ls.security_code = pd.security_code
                LEFT JOIN av ON ls.security_code = av.security_code
                LEFT JOIN tma ON ls.security_code = tma.tma_code),
ca AS (SELECT * {_rebound_flags(SUMMARY_MIN_VALUE)} {flags6} FROM ca0)
{_asof_select()}
FROM ca WHERE has_long_lower_shadow AND is_liquid"""


def _sql_rebound_asof_backtest() -> str:
    ds = _latest("stock_summary", "security_code, data_date", "ts DESC",
                 "board_code = 'RG' AND lowest_price IS NOT NULL AND trade_volume IS NOT NULL "
                 "AND close_price IS NOT NULL")
    return with_views("stock_summary") + f""", {TICKS},
d0 AS (SELECT *, CAST(strptime(data_date, '%Y%m%d') AS DATE) AS dday FROM {ds} a),
d1 AS (SELECT *, lag(dday) OVER w AS pday, lag(lowest_price) OVER w AS plow, lag(trade_volume) OVER w AS pvol,
              sum(trade_volume) OVER f AS vs, max(close_price) OVER f AS mx, min(close_price) OVER f AS mn,
              count(data_date) OVER f AS vn
       FROM d0 WINDOW w AS (PARTITION BY security_code ORDER BY dday),
                      f AS (PARTITION BY security_code ORDER BY dday
                            RANGE BETWEEN INTERVAL 20 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)),
d AS (SELECT * EXCLUDE (close_price), close_price AS current_price,
             CASE WHEN pday >= dday - INTERVAL 20 DAY THEN plow END AS previous_low,
             CASE WHEN pday >= dday - INTERVAL 20 DAY THEN pvol END AS prev_volume,
             CASE WHEN vn > 0 THEN vs END AS vol_sum, CASE WHEN vn > 0 THEN mx END AS max_price_20d,
             CASE WHEN vn > 0 THEN mn END AS min_price_20d, CASE WHEN vn > 0 THEN vn END AS vol_days
      FROM d1),
tma AS (SELECT security_code AS tma_code, trade_day AS tma_day, {_tape_aggs('tma_')}
        FROM tk2 GROUP BY security_code, trade_day HAVING count(*) >= {MIN_TRADES}),
ca0 AS (SELECT d.*, tma.* FROM d LEFT JOIN tma ON d.security_code = tma.tma_code AND d.dday = tma.tma_day),
ca AS (SELECT * {_rebound_flags(SUMMARY_MIN_VALUE)} {_asof_flags6()} FROM ca0)
{_asof_select()}
FROM ca WHERE has_long_lower_shadow AND is_liquid"""


def _sql_top_movers(direction: str) -> str:
    order = "chg DESC, security_code" if direction == "gainer" else "chg ASC, security_code"
    return with_views("stock_summary") + f""",
b AS (SELECT security_code, close_price, previous_price,
             CAST(close_price - previous_price AS DOUBLE) / NULLIF(CAST(previous_price AS DOUBLE), 0) AS chg,
             {_pct('close_price', 'previous_price')} AS pct_change
      FROM {_ls_on_max()} x WHERE previous_price > 0)
SELECT 'top_{direction}' AS kind, row_number() OVER (ORDER BY {order}) AS rank, security_code,
       {_d('close_price')} AS close_price, {_d('previous_price')} AS previous_price, pct_change
FROM b ORDER BY {order} LIMIT 10"""


def _sql_most_active() -> str:
    return with_views("stock_summary") + f"""
SELECT 'most_active' AS kind, row_number() OVER (ORDER BY trade_value DESC, security_code) AS rank,
       security_code, trade_value, trade_volume, trade_frequency
FROM {_ls_on_max()} x ORDER BY trade_value DESC, security_code LIMIT 10"""


def _sql_book_totals() -> str:
    return with_views("orderbook") + """,
last AS (SELECT security_code, side, max(ts) AS ts FROM orderbook GROUP BY 1, 2),
cur AS (SELECT o.* FROM orderbook o JOIN last l ON o.security_code = l.security_code AND o.side = l.side
        AND o.ts = l.ts)
SELECT security_code,
  CAST(sum(CASE WHEN side = 'B' THEN frequency ELSE 0 END) AS BIGINT) AS total_bid_queue,
  CAST(sum(CASE WHEN side = 'B' THEN volume ELSE 0 END) AS BIGINT) AS total_bid_volume,
  CAST(sum(CASE WHEN side = 'O' THEN frequency ELSE 0 END) AS BIGINT) AS total_offer_queue,
  CAST(sum(CASE WHEN side = 'O' THEN volume ELSE 0 END) AS BIGINT) AS total_offer_volume
FROM cur GROUP BY security_code"""


def _sql_key_audit() -> str:
    parts = []
    for t in AUDITED:
        keys = ", ".join(KEYS[t])
        parts.append(f"""SELECT '{t}' AS table_name, count(*) AS duplicate_keys,
       CAST(COALESCE(sum(n_rows - 1), 0) AS BIGINT) AS surplus_rows
FROM (SELECT count(*) AS n_rows FROM {t} GROUP BY {keys} HAVING count(*) > 1)""")
    return with_views(*AUDITED) + "\nUNION ALL\n".join(parts)


def _sql_null_audit() -> str:
    parts = []
    for t in NULL_AUDITED:
        for c in AU.not_null_columns(SCHEMAS[t]):
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                         f"count(*) FILTER (WHERE \"{c}\" IS NULL) AS null_count FROM {t}")
    return with_views(*NULL_AUDITED) + "\nUNION ALL\n".join(parts)


def _rsi_cte(src: str) -> str:
    return f"""rc AS (SELECT *, "close" - lag("close") OVER (PARTITION BY code ORDER BY trade_date) AS chg FROM {src}),
rs AS (SELECT *, sum(CASE WHEN chg > 0 THEN chg ELSE 0 END) OVER w14 AS g,
              sum(CASE WHEN chg < 0 THEN -chg ELSE 0 END) OVER w14 AS l, count(chg) OVER w14 AS nc
       FROM rc WINDOW w14 AS (PARTITION BY code ORDER BY trade_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
rsi AS (SELECT * EXCLUDE (chg, g, l, nc),
               CASE WHEN nc >= 14 THEN CASE WHEN l = 0 THEN CAST(100 AS DOUBLE)
                    ELSE CAST(100 AS DOUBLE) - CAST(100 AS DOUBLE) / (CAST(1 AS DOUBLE) + CAST(g AS DOUBLE) / CAST(l AS DOUBLE))
                    END END AS rsi_14 FROM rs)"""


def _sql_rsi14() -> str:
    return with_views("history_ohlc") + ", h AS (SELECT * FROM history_ohlc WHERE \"close\" IS NOT NULL), " + \
        _rsi_cte("h") + """
SELECT code, strftime(trade_date, '%Y-%m-%d') AS trade_date, CAST("close" AS DOUBLE) AS "close", rsi_14 FROM rsi"""


def _sql_rsi14_wilder() -> str:
    """Wilder smoothing as a recursive CTE (same IEEE steps as the Spark side)."""
    return "WITH RECURSIVE " + with_views("history_ohlc")[len("WITH "):] + """,
h AS (SELECT code, trade_date, "close",
             row_number() OVER (PARTITION BY code ORDER BY trade_date) AS i,
             "close" - lag("close") OVER (PARTITION BY code ORDER BY trade_date) AS chg
      FROM history_ohlc WHERE "close" IS NOT NULL),
g AS (SELECT code, i, CASE WHEN chg > 0 THEN chg ELSE 0 END AS gain,
             CASE WHEN chg < 0 THEN -chg ELSE 0 END AS loss FROM h WHERE i > 1),
seed AS (SELECT code, CAST(sum(gain) AS DOUBLE) / 14 AS ag, CAST(sum(loss) AS DOUBLE) / 14 AS al
         FROM g WHERE i BETWEEN 2 AND 15 GROUP BY code HAVING count(*) = 14),
r(code, i, ag, al) AS (
  SELECT code, 15, ag, al FROM seed
  UNION ALL
  SELECT r.code, r.i + 1, (r.ag * 13 + CAST(g.gain AS DOUBLE)) / 14, (r.al * 13 + CAST(g.loss AS DOUBLE)) / 14
  FROM r JOIN g ON g.code = r.code AND g.i = r.i + 1)
SELECT h.code, strftime(h.trade_date, '%Y-%m-%d') AS trade_date, CAST(h."close" AS DOUBLE) AS "close",
       CASE WHEN r.al IS NULL THEN NULL WHEN r.al = 0 THEN CAST(100 AS DOUBLE)
            ELSE CAST(100 AS DOUBLE) - CAST(100 AS DOUBLE) / (CAST(1 AS DOUBLE) + r.ag / r.al) END AS rsi_wilder
FROM h LEFT JOIN r ON h.code = r.code AND h.i = r.i"""


def _sql_swing(latest: bool) -> str:
    def win(n):
        return f"(PARTITION BY code ORDER BY trade_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    day = "WHERE trade_date = (SELECT max(trade_date) FROM history_ohlc)" if latest else ""
    rules = {
        "rule_01": "market_cap_rp IS NOT NULL AND market_cap_rp < 5000000000000",
        "rule_02": "free_float_pct IS NOT NULL AND free_float_pct < 40",
        "rule_03": 'n50 = 50 AND "close" * n50 > s50',
        "rule_04": "n100 = 100 AND s50 * n100 > s100 * n50",
        "rule_05": "n200 = 200 AND s100 * n200 > s200 * n100",
        "rule_06": "vn60 = 60 AND vs20 * vn60 > vs60 * vn20",
        "rule_07": "vn20 = 20 AND volume * vn20 > vs20",
        "rule_08": f'"value" > {HISTORY_MIN_VALUE}',
        "rule_09": "n_rows >= 60 AND lowest_60 > 0 AND highest_60 < 1.8 * lowest_60",
        "rule_10": 'n_rows >= 20 AND "close" >= highest_20',
        "rule_11": "rsi_14 > 55.0 AND rsi_14 < 70.0",
        "rule_12": 'n200 = 200 AND "close" * n200 < 2 * s200',
        "rule_13": '"close" > 0 AND (high - low) < 0.12 * "close"',
    }
    flags = ",\n  ".join(f"COALESCE({v}, false) AS {k}" for k, v in rules.items())
    met = " + ".join(f"CAST({k} AS INT)" for k in rules)
    return with_views("history_ohlc", "market_cap", "free_float") + f""",
h AS (SELECT *, sum("close") OVER {win(50)} AS s50, count("close") OVER {win(50)} AS n50,
             sum("close") OVER {win(100)} AS s100, count("close") OVER {win(100)} AS n100,
             sum("close") OVER {win(200)} AS s200, count("close") OVER {win(200)} AS n200,
             sum(volume) OVER {win(20)} AS vs20, count(volume) OVER {win(20)} AS vn20,
             sum(volume) OVER {win(60)} AS vs60, count(volume) OVER {win(60)} AS vn60,
             max("close") OVER {win(60)} AS highest_60, min("close") OVER {win(60)} AS lowest_60,
             max("close") OVER {win(20)} AS highest_20,
             row_number() OVER (PARTITION BY code ORDER BY trade_date) AS n_rows
      FROM history_ohlc WHERE "close" IS NOT NULL),
{_rsi_cte('h')},
mc AS (SELECT code, last_day(make_date(year, month, 1)) AS cap_date,
              CAST(market_capitalization AS DECIMAL(30,0)) * 1000000 AS market_cap_rp FROM market_cap),
j AS (SELECT rsi.*, mc.market_cap_rp, ff.free_float_pct
      FROM rsi ASOF LEFT JOIN mc ON rsi.code = mc.code AND rsi.trade_date >= mc.cap_date
      LEFT JOIN free_float ff ON rsi.code = ff.code {day}),
f AS (SELECT *, {flags} FROM j)
SELECT code AS security_code, strftime(trade_date, '%Y-%m-%d') AS trade_date, CAST("close" AS DOUBLE) AS "close",
       volume, "value", {_div('s50', 'n50')} AS ma50, {_div('s100', 'n100')} AS ma100, {_div('s200', 'n200')} AS ma200,
       {_div('vs20', 'vn20')} AS avg_volume_20, {_div('vs60', 'vn60')} AS avg_volume_60,
       CAST(highest_60 AS DOUBLE) AS highest_60, CAST(lowest_60 AS DOUBLE) AS lowest_60,
       CAST(highest_20 AS DOUBLE) AS highest_20, rsi_14, CAST(market_cap_rp AS DOUBLE) AS market_cap_rp,
       free_float_pct, {", ".join(rules)}, CAST({met} AS BIGINT) AS rules_met
FROM f"""


def _sql_feed_trades() -> str:
    return with_views("trades") + """
SELECT trade_no, trade_date, trade_time,
       strftime(strptime(trade_date || trade_time, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S.%f') AS ts,
       security_code, board_code, CAST(price AS DOUBLE) AS price, volume FROM trades"""


def _sql_feed_summary() -> str:
    cols = SUMMARY_COLS.replace("strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts",
                                "strftime(strptime(data_date || data_time, '%Y%m%d%H%M%S'), "
                                "'%Y-%m-%d %H:%M:%S.%f') AS ts")
    return with_views("stock_summary") + f"\nSELECT {cols} FROM stock_summary"


def _sql_feed_orderbook() -> str:
    return with_views("orderbook") + """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, security_code, side, CAST(level AS BIGINT) AS level,
       CAST(frequency AS BIGINT) AS frequency, CAST(price AS DOUBLE) AS price, volume FROM orderbook"""


def _sql_feed_rank_lists() -> str:
    ds = _latest("stock_summary", "security_code, data_date", "ts DESC")
    return with_views("stock_summary") + f"""
SELECT data_date AS received_at, 'most_active' AS kind, rank, security_code
FROM (SELECT data_date, security_code,
             row_number() OVER (PARTITION BY data_date ORDER BY trade_value DESC, security_code) AS rank
      FROM {ds} d)
WHERE rank <= 10"""


def _sql_feed_rejects() -> str:
    return with_views("trades") + """
SELECT 'field count' AS reason, count(*) AS n_lines FROM trades WHERE board_code = 'NG' HAVING count(*) > 0"""


EOD_COLS = """trade_no, session, board_code, seller_broker, seller_investor_type, buyer_broker, buyer_investor_type,
       security_code, volume, CAST(price AS DOUBLE) AS price, seller_order_no, buyer_order_no, trade_time,
       strftime(strptime(strftime(trade_date, '%Y%m%d') || trade_time, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S.%f') AS ts"""


def _sql_feed_trades_eod() -> str:
    return with_views("trades_eod") + f"""
SELECT {EOD_COLS}, strftime(trade_date, '%Y-%m-%d') AS trade_date FROM trades_eod"""


def _sql_stream_eod_resend() -> str:
    return with_views("trades_eod") + f"""
SELECT {EOD_COLS}, strftime(trade_date, '%Y%m%d') AS trade_date FROM trades_eod"""


def _sql_feed_index() -> str:
    sums = ", ".join(f'CAST(sum("{c}") AS DECIMAL(20,2)) AS s_{c}' for c in ("open", "high", "low", "close"))
    return with_views("history_ohlc") + f""",
d AS (SELECT trade_date, {sums}, CAST(sum(freq) AS BIGINT) AS frequency, CAST(sum(volume) AS BIGINT) AS volume,
             CAST(sum("value") AS BIGINT) AS val, count(*) FILTER ("close" > "open") AS up,
             count(*) FILTER ("close" < "open") AS down, count(*) FILTER ("close" = "open") AS unchanged
      FROM history_ohlc GROUP BY trade_date),
p AS (SELECT *, coalesce(lag(s_close) OVER (ORDER BY trade_date), s_close) AS prev FROM d)
SELECT 'COMPX' AS index_code, strftime(trade_date, '%Y%m%d') AS data_date, '160000' AS data_time,
       strftime(trade_date + INTERVAL 16 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS ts, CAST(s_close AS DOUBLE) AS last_index,
       CAST(prev AS DOUBLE) AS prev_index, CAST(s_open AS DOUBLE) AS open_index, CAST(s_high AS DOUBLE) AS high_index,
       CAST(s_low AS DOUBLE) AS low_index, CAST(s_close - prev AS DOUBLE) AS change, 0.0::DOUBLE AS change_rate, frequency,
       volume // 100 AS volume_lots, CAST(val || 'E2' AS DOUBLE) AS "value", up, down, unchanged,
       CAST(0 AS BIGINT) AS no_transaction, CAST(val || '.5E3' AS DOUBLE) AS market_value FROM p"""


def _sql_feed_stock_master() -> str:
    return with_views("stock_fundamentals") + """
SELECT security_code, source AS security_name, CAST(0 AS BIGINT) AS security_status, 'ORDI' AS security_type,
       '0011' AS sub_industry, 100.0::DOUBLE AS ipo_price, 250.0::DOUBLE AS base_price,
       shares_outstanding AS listed_shares, shares_outstanding // 3 AS tradable_listed_shares,
       CAST(100 AS BIGINT) AS shares_per_lot, CAST(NULL AS VARCHAR) AS remarks, '----------' AS security_remarks2,
       CAST(0 AS BIGINT) AS weight FROM stock_fundamentals"""


def _sql_feed_brokers() -> str:
    return """
SELECT 'C' || c_custkey AS broker_code, c_name AS broker_name, c_custkey % 2 AS broker_status FROM customer"""


def _sql_market_cap_load() -> str:
    return with_views("market_cap") + """
SELECT code, listed_stocks, number_of_listed_shares,
       CAST(round(CAST(market_capitalization AS DECIMAL(30,4)) + month * 0.0625, 0) AS BIGINT) AS market_capitalization,
       1.25::DOUBLE AS percentage, CAST(month AS BIGINT) AS month, CAST(year AS BIGINT) AS year FROM market_cap"""


def _sql_odd_lines(columns: str) -> str:
    return with_views("trades") + f"""
SELECT {columns} FROM (SELECT trade_no % {len(ODD_LINES)} AS form FROM trades)
"""


REASON = """CASE WHEN form = 1 THEN 'bad prefix' WHEN form = 2 THEN 'unknown type' WHEN form = 3 THEN 'field count'
       WHEN form IN (4, 10) THEN 'bad value' WHEN form IN (5, 9) THEN 'empty code' ELSE 'no element' END"""


def _sql_feed_reject_reasons() -> str:
    return _sql_odd_lines(f"{REASON} AS reason, count(*) AS n_lines") + "WHERE form BETWEEN 1 AND 10 GROUP BY 1"


def _sql_feed_conservation() -> str:
    return _sql_odd_lines("""CASE form WHEN 0 THEN '1' WHEN 11 THEN '4' WHEN 12 THEN '6' ELSE 'reject' END AS tag,
       count(*) AS n_lines, CAST(sum(CASE WHEN form IN (11, 12) THEN 2 ELSE 1 END) AS BIGINT) AS n_rows""") + "GROUP BY 1"


def _sql_stream_daily_ohlc() -> str:
    return with_views("trades") + """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d %H:%M:%S.%f') AS bucket, security_code,
       CAST(arg_min(price, (ts, trade_no)) AS DOUBLE) AS "open", CAST(max(price) AS DOUBLE) AS high,
       CAST(min(price) AS DOUBLE) AS low, CAST(arg_max(price, (ts, trade_no)) AS DOUBLE) AS "close",
       CAST(sum(volume) AS BIGINT) AS volume, CAST(round(sum(price * volume)) AS BIGINT) AS "value"
FROM trades GROUP BY security_code, CAST(ts AS DATE)"""


def _sql_stream_dedupe_trades() -> str:
    return with_views("trades") + """
SELECT trade_no, trade_date, trade_time, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, security_code, board_code,
       CAST(price AS DOUBLE) AS price, volume FROM trades"""


def _sql_stream_top_movers() -> str:
    return with_views("stock_summary") + f""",
m AS (SELECT date_trunc('minute', ts) AS minute, security_code,
             arg_max(close_price, (ts, data_date)) AS close_price,
             arg_max(previous_price, (ts, data_date)) AS previous_price
      FROM stock_summary WHERE {MOD} BETWEEN 540 AND 1020 GROUP BY 1, 2),
c AS (SELECT *, CAST(close_price - previous_price AS DOUBLE) / NULLIF(CAST(previous_price AS DOUBLE), 0) AS chg
      FROM m WHERE previous_price > 0),
g AS (SELECT 'top_gainer' AS kind, minute, row_number() OVER (PARTITION BY minute ORDER BY chg DESC, security_code)
             AS rank, security_code, {_pct('close_price', 'previous_price')} AS pct_change FROM c),
l AS (SELECT 'top_loser' AS kind, minute, row_number() OVER (PARTITION BY minute ORDER BY chg ASC, security_code)
             AS rank, security_code, {_pct('close_price', 'previous_price')} AS pct_change FROM c)
SELECT kind, strftime(minute, '%Y-%m-%d %H:%M:%S.%f') AS minute, rank, security_code, pct_change
FROM (SELECT * FROM g UNION ALL SELECT * FROM l) WHERE rank <= 10"""


def oracle_sql() -> dict[str, str]:
    return _corpus_sql() | {
        "rebound_candidates": _sql_rebound_candidates(),
        "criteria_counts": _sql_criteria_counts(),
        "rebound_detail": _sql_rebound_detail(),
        "rebound_detail_summary": _sql_rebound_detail_summary(False),
        "rebound_detail_3b": _sql_rebound_detail_summary(True),
        "rebound_strict": _sql_rebound_strict(5),
        "rebound_relaxed": _sql_rebound_strict(4),
        "rebound_backtest": _sql_rebound_backtest(),
        "table_counts": _sql_table_counts(),
        "coverage_summary": _sql_coverage("stock_summary", "security_code", "data_date", False),
        "coverage_history": _sql_coverage("history_ohlc", "code", "trade_date", True),
        "coverage_today": _sql_coverage_today(),
        "sample_latest": _sql_sample_latest(),
        "latest_date": _sql_latest_date(),
        "date_match": _sql_date_match(),
        "missing_fundamentals": _sql_missing_fundamentals(),
        "fundamentals_coverage": _sql_fundamentals_coverage(),
        "latest_snapshot": _sql_latest_snapshot(),
        "eod_snapshots": _sql_eod_snapshots(),
        "previous_day_merged": _sql_previous_day_merged(),
        "afternoon_trend": _sql_afternoon_trend(),
        "afternoon_counts": _sql_afternoon_counts(),
        "snapshot_counts": _sql_snapshot_counts(),
        "daily_screen": _sql_daily_screen(),
        "daily_screen_backtest": _sql_daily_screen_backtest(),
        "daily_marks": _sql_daily_marks(),
        "ma_coverage": _sql_ma_coverage(),
        "ma5_breakout": _sql_ma5_breakout(True),
        "ma5_breakout_all": _sql_ma5_breakout(False),
        "ma20_swing": _sql_ma20_swing(False),
        "ma20_swing_latest": _sql_ma20_swing(True),
        "daily_bars": _sql_daily_bars(),
        "daily_ohlc_build": _sql_daily_ohlc_build(),
        "sideways_7d": _sql_sideways_7d(True),
        "sideways_7d_all": _sql_sideways_7d(False),
        "sideways_60d": _sql_sideways_60d(True),
        "sideways_60d_all": _sql_sideways_60d(False),
        "sideways_60d_asof": _sql_sideways_60d_asof(),
        "current_sideways": _sql_current_sideways(),
        "sideways_upsert": _sql_sideways_60d(False),
        "tick_direction": _sql_tick_direction(),
        "trade_tape_summary": _sql_trade_tape_summary(),
        "rebound_asof": _sql_rebound_asof(),
        "rebound_asof_backtest": _sql_rebound_asof_backtest(),
        "top_gainers": _sql_top_movers("gainer"),
        "top_losers": _sql_top_movers("loser"),
        "most_active": _sql_most_active(),
        "book_totals": _sql_book_totals(),
        "key_audit": _sql_key_audit(),
        "null_audit": _sql_null_audit(),
        "swing_spec": _sql_swing(False),
        "swing_latest": _sql_swing(True),
        "rsi14": _sql_rsi14(),
        "rsi14_wilder": _sql_rsi14_wilder(),
        "feed_trades": _sql_feed_trades(),
        "feed_summary": _sql_feed_summary(),
        "feed_orderbook": _sql_feed_orderbook(),
        "feed_book_summary": _sql_book_totals(),
        "feed_rank_lists": _sql_feed_rank_lists(),
        "feed_rejects": _sql_feed_rejects(),
        "stream_daily_ohlc": _sql_stream_daily_ohlc(),
        "stream_latest_snapshot": _sql_latest_snapshot(),
        "stream_dedupe_trades": _sql_stream_dedupe_trades(),
        "stream_feed_trades": _sql_feed_trades(),
        "stream_top_movers": _sql_stream_top_movers(),
        "stream_sideways_state": _sql_sideways_60d(True),
        "rebound_strict_loose": _sql_rebound_strict(5, LOOSE_SHADOW),
        "rebound_strict_backtest": _sql_rebound_backtest(5),
        "avg_volume_daily": _sql_daily_stats("CAST(sum(trade_volume) AS DOUBLE) AS vol_sum, "
                                             "count(DISTINCT data_date) AS vol_days"),
        "range_stats": _sql_daily_stats(
            "CAST(sum(trade_volume) AS DOUBLE) AS vol_sum, CAST(max(close_price) AS DOUBLE) AS max_price_20d, "
            "CAST(min(close_price) AS DOUBLE) AS min_price_20d, count(DISTINCT data_date) AS vol_days"),
        "ma20_swing_last_hit": _sql_ma20_swing_last_hit(),
        "coverage_current_date": _sql_coverage_current_date(),
        "market_cap_load": _sql_market_cap_load(),
        "feed_trades_eod": _sql_feed_trades_eod(),
        "feed_index": _sql_feed_index(),
        "feed_stock_master": _sql_feed_stock_master(),
        "feed_brokers": _sql_feed_brokers(),
        "feed_reject_reasons": _sql_feed_reject_reasons(),
        "feed_conservation": _sql_feed_conservation(),
        "stream_two_feeds": _sql_feed_trades(),
        "stream_eod_resend": _sql_stream_eod_resend(),
        "stream_sideways_late": _sql_sideways_60d(False),
    }
