"""Market-table views derived from the driver's test tables.

The market tables do not exist in the test data, so every query runs on these
deterministic views. All views are lazy DataFrames over the Parquet scans, so their
work grows with the input tables and Catalyst prunes columns through them.

* ``trades``        <- ``events``  (one trade per event, a symbol for every five users)
* ``stock_summary`` <- ``trades``  (day-cumulative snapshot after every trade)
* ``history_ohlc``  <- ``lineitem`` (one bar per supplier and ship date)
* ``daily_ohlc``    <- ``history_ohlc``
* ``orderbook``     <- ``events`` (hourly book, level = price rank per side)
* ``stock_fundamentals`` <- ``supplier`` (suppliers with a positive balance)
* ``market_cap``    <- ``history_ohlc`` x ``stock_fundamentals`` (month-end close)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bursa.sources.schemas import PRICE


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _code(x) -> F.Column:
    text = x.cast("string")  # padded to four digits, longer keys stay whole
    return F.concat(F.lit("S"), F.lpad(text, F.greatest(F.lit(4), F.length(text)), F.lit("0")))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("trade_no"),
        F.date_format("ts", "yyyyMMdd").alias("trade_date"),
        F.date_format("ts", "HHmmss").alias("trade_time"),
        F.col("ts"),
        _code(F.expr("user_id div 5")).alias("security_code"),
        F.when(F.col("event_type") == "error", F.lit("NG")).otherwise(F.lit("RG")).alias("board_code"),
        F.col("value").cast(PRICE).alias("price"),
        (F.lit(100) * (F.lit(1) + F.col("event_id") % 50)).cast("bigint").alias("volume"),
    )


def trades_eod(spark: SparkSession, sf_dir: str, get=None) -> DataFrame:
    """The trades with the brokers, investor types and order numbers of the end-of-day resend."""
    t, no = _resolver(spark, sf_dir, get)("trades"), F.col("trade_no")
    kind = lambda k: F.substring(F.lit("IASF"), (k % 4 + 1).cast("int"), F.lit(1))
    return t.select(
        "trade_no", (no % 2 + 1).cast("int").alias("session"), "board_code",
        F.concat(F.lit("B"), (no % 97).cast("string")).alias("seller_broker"), kind(no).alias("seller_investor_type"),
        F.concat(F.lit("B"), (no * 7 % 89).cast("string")).alias("buyer_broker"),
        kind(F.floor(no / 4).cast("bigint")).alias("buyer_investor_type"), "security_code", "volume", "price",
        F.to_date("ts").alias("trade_date"), (no * 2).alias("seller_order_no"), (no * 2 + 1).alias("buyer_order_no"),
        "trade_time", "ts")


def summary_from_trades(t: DataFrame) -> DataFrame:
    """Day-cumulative snapshots: one row per trade carrying the running OHLC,
    volume, value and count of its symbol-day, plus the previous day's close."""
    from bursa.operators.cumulative import day_cumulative
    r = day_cumulative(t).select(
        F.col("trade_date").alias("data_date"), F.col("trade_time").alias("data_time"), "ts",
        "security_code", "board_code", "opening_price", "highest_price", "lowest_price",
        F.col("price").alias("close_price"), "trade_volume", "trade_value", "trade_frequency")
    day_close = (t.groupBy("security_code", F.col("trade_date").alias("data_date"))
                  .agg(F.max_by("price", "ts").alias("c")))
    prev = day_close.select(
        "security_code", "data_date",
        F.lag("c").over(Window.partitionBy("security_code").orderBy("data_date")).alias("previous_price"))
    return r.join(prev, ["security_code", "data_date"]).select(
        "data_date", "data_time", "ts", "security_code", "board_code", "opening_price",
        "highest_price", "lowest_price", "close_price", "trade_volume", "trade_value",
        "trade_frequency", "previous_price")


def _resolver(spark: SparkSession, sf_dir: str, get):
    return get or (lambda name: VIEWS[name](spark, sf_dir))


def stock_summary(spark: SparkSession, sf_dir: str, get=None) -> DataFrame:
    return summary_from_trades(_resolver(spark, sf_dir, get)("trades"))


def history_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        _code(F.col("l_suppkey")).alias("code"),
        F.to_date("l_shipdate").alias("trade_date"),
        F.col("l_extendedprice").cast(PRICE).alias("p"),
        F.col("l_quantity").cast("bigint").alias("v"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"),
    )
    order = F.struct("k", "p")
    return li.groupBy("code", "trade_date").agg(
        F.min_by("p", order).alias("open"),
        F.max("p").alias("high"),
        F.min("p").alias("low"),
        F.max_by("p", order).alias("close"),
        F.sum("v").cast("bigint").alias("volume"),
        F.round(F.sum(F.col("p") * F.col("v")), 0).cast("bigint").alias("value"),
        F.count(F.lit(1)).alias("freq"),
    )


def daily_ohlc(spark: SparkSession, sf_dir: str, get=None) -> DataFrame:
    h = _resolver(spark, sf_dir, get)("history_ohlc")
    return h.select(
        F.col("trade_date").cast("timestamp_ntz").alias("bucket"),
        F.col("code").alias("security_code"), "open", "high", "low", "close", "volume", "value")


def orderbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly book: each event is a resting order; bids ranked high→low, offers low→high."""
    e = _read(spark, sf_dir, "events")
    o = e.select(
        F.date_trunc("hour", "ts").alias("ts"),
        _code(F.expr("user_id div 5")).alias("security_code"),
        F.when(F.col("event_id") % 2 == 0, F.lit("B")).otherwise(F.lit("O")).alias("side"),
        (F.lit(1) + F.col("event_id") % 7).cast("int").alias("frequency"),
        F.col("value").cast(PRICE).alias("price"),
        (F.lit(100) * (F.lit(1) + F.col("event_id") % 50)).cast("bigint").alias("volume"),
        F.col("event_id"),
    )
    from bursa.operators.latest import exact_rank
    signed = F.when(F.col("side") == "B", -F.col("price")).otherwise(F.col("price"))
    # level = rank by price within each (symbol, hour, side) book, split across tasks for hot books
    ranked = exact_rank(o.withColumn("__signed", signed), ["security_code", "ts", "side"],
                        ["__signed", "event_id"], "level")
    return ranked.select("ts", "security_code", "side", "level", "frequency", "price", "volume")


def stock_fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    return s.where(F.col("s_acctbal") > 0).select(
        _code(F.col("s_suppkey")).alias("security_code"),
        (F.round(F.col("s_acctbal") * 1_000_000, 0)).cast("bigint").alias("shares_outstanding"),
        F.lit("2024-12-31").cast("date").alias("last_updated"),
        F.col("s_name").alias("source"),
    )


def market_cap(spark: SparkSession, sf_dir: str, get=None) -> DataFrame:
    """Month-end close x shares, in millions (the stored unit), per code and month."""
    get = _resolver(spark, sf_dir, get)
    h = get("history_ohlc")
    m = (h.groupBy("code", F.year("trade_date").alias("year"), F.month("trade_date").alias("month"))
          .agg(F.max_by("close", "trade_date").alias("month_close")))
    f = get("stock_fundamentals")
    j = m.join(f, m.code == f.security_code)
    j = j.withColumn("__num", (j.month_close * 100).cast("decimal(20,0)")
                     * j.shares_outstanding.cast("decimal(20,0)") + F.lit(50_000_000))
    # round(close * shares / 1e6) in exact integer arithmetic (values are positive)
    cap = F.expr("__num div 100000000")
    return j.select(
        "code",
        F.col("source").alias("listed_stocks"),
        F.col("shares_outstanding").alias("number_of_listed_shares"),
        cap.cast("bigint").alias("market_capitalization"),
        F.lit(None).cast("decimal(9,4)").alias("percentage"),
        F.col("month").cast("int"), F.col("year").cast("int"),
    )


def free_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-float percentage per supplier code (10..69 %, from the nation key)."""
    s = _read(spark, sf_dir, "supplier")
    return s.select(_code(F.col("s_suppkey")).alias("code"),
                    (F.lit(10) + (F.col("s_nationkey") * 3) % 60).cast("double").alias("free_float_pct"))


VIEWS = {
    "trades": trades,
    "trades_eod": trades_eod,
    "stock_summary": stock_summary,
    "history_ohlc": history_ohlc,
    "daily_ohlc": daily_ohlc,
    "orderbook": orderbook,
    "stock_fundamentals": stock_fundamentals,
    "market_cap": market_cap,
    "free_float": free_float,
}


MARKET_DIR = "_market"


def _stored_path(spark: SparkSession, sf_dir: str, name: str) -> str | None:
    path = f"{sf_dir.rstrip('/')}/{MARKET_DIR}/{name}"
    jvm = spark._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return path if fs.exists(jpath) else None


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A market table: the stored copy under ``<sf_dir>/_market/<name>`` when one was
    materialised (read with its declared schema, partitions pruned), else the view
    derived from the raw test tables."""
    stored = _stored_path(spark, sf_dir, name)
    if stored is not None:
        from bursa.sources.schemas import SCHEMAS, read_table
        return read_table(spark, name, stored, partitions=True) if name in SCHEMAS else spark.read.parquet(stored)
    return VIEWS[name](spark, sf_dir)


def materialize(spark: SparkSession, sf_dir: str, out_dir: str, names=None) -> dict[str, str]:
    """Write the derived market tables as Parquet under ``<out_dir>/_market``,
    partitioned by their date column where one is declared. Tables derived from
    another market table (snapshots from trades, daily bars and market caps from the
    history) are built from the stored parent, so each derivation runs once.
    Returns the table paths."""
    from bursa.sources.schemas import PARTITION_COLUMNS, SCHEMAS, with_partitions
    base = f"{out_dir.rstrip('/')}/{MARKET_DIR}"
    paths: dict[str, str] = {}

    def get(name: str) -> DataFrame:
        if name in paths:
            df = spark.read.parquet(paths[name])
            return df.select(*[f.name for f in SCHEMAS[name].fields]) if name in SCHEMAS else df
        return VIEWS[name](spark, sf_dir)

    for name in names or VIEWS:
        fn = VIEWS[name]
        df = fn(spark, sf_dir, get) if "get" in fn.__code__.co_varnames else fn(spark, sf_dir)
        if name in SCHEMAS:
            df = with_partitions(df.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[name].fields]), name)
        w = df.write.mode("overwrite")
        parts = PARTITION_COLUMNS.get(name)
        if parts:
            w = w.partitionBy(*parts)
        w.parquet(f"{base}/{name}")
        paths[name] = f"{base}/{name}"
    return paths
