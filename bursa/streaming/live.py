"""Streaming operators (T-01..T-06).

* Event time is ``ts`` cast to ``TIMESTAMP`` (watermarks reject ``TIMESTAMP_NTZ``);
  run with ``spark.sql.session.timeZone=UTC`` so the cast is the identity.
* Stateful aggregates run in ``update`` mode and are merged into their table with
  ``foreachBatch`` + the key upsert, so the stored table equals the batch result
  after any number of micro-batches and a restarted query resumes from its
  checkpoint (in the shared ``spark.checkpoint.dir``).
* Global rankings (top movers) are not expressible as a streaming aggregate; the
  stream keeps the per-minute, per-symbol state, and each batch ranks the minutes it touched.
* What may come later than any watermark (the end-of-day resend of trades, late daily
  bars) is merged into the stored table, whose touched partitions are the state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bursa import constants as K
from bursa.functions.expr import guarded_ratio, pct_change
from bursa.sources import feed as FD
from bursa.sources.schemas import PARTITION_COLUMNS
from bursa.sources.sinks import append, upsert


def _epoch_ntz() -> F.Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def with_event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Event time for watermarks and windows: the wall-clock ``ts`` read as a UTC instant,
    so day and minute windows follow the wall clock whatever the session time zone."""
    micros = F.timestamp_diff("MICROSECOND", _epoch_ntz(), F.col(col))
    return df.withColumn("event_time", F.timestamp_micros(micros))


def wall_clock(instant_col: str) -> F.Column:
    """Inverse of ``with_event_time`` for window bounds: back to ``TIMESTAMP_NTZ``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(F.col(instant_col)), _epoch_ntz())


# --- T-01 feed ingest ---------------------------------------------------------------

def feed_source(spark: SparkSession, kind: str = "text", path: str | None = None,
                max_files: int | None = None, **options) -> DataFrame:
    """Streaming feed lines as ``value`` (text) and ``received_at`` (arrival time).

    ``kind="text"`` reads newline-delimited files from ``path``; ``kind="kafka"`` reads
    a topic (``subscribe=...``, ``kafka.bootstrap.servers=...``; needs the Kafka
    connector on the classpath) and uses the broker timestamp as arrival time.
    """
    if kind == "text":
        reader = spark.readStream.format("text")
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.load(path).withColumn("received_at", F.localtimestamp())
    if kind == "kafka":
        reader = spark.readStream.format("kafka")
        for k, v in options.items():
            reader = reader.option(k.replace("_", "."), v) if k.startswith("kafka_") else reader.option(k, v)
        raw = reader.load()
        return raw.select(F.col("value").cast("string").alias("value"),
                          F.col("timestamp").cast("timestamp_ntz").alias("received_at"))
    raise ValueError("kind is 'text' or 'kafka'")


def stream_feed(spark: SparkSession, in_dir: str, out_base: str, checkpoint: str,
                trigger: dict | None = None, max_files: int | None = None,
                lines: DataFrame | None = None) -> StreamingQuery:
    """Feed lines -> typed tables (trades, stock_summary, orderbook, rejects...).

    Each micro-batch is parsed once, split by record type and written to its tables under
    the query's id and its batch id, so a batch that is retried replaces what it wrote
    before, and another stream (or one with a new checkpoint) into the same tables adds
    to them; the arrival time of the batch is the order-book ``ts`` (the wire carries none). ``lines``
    overrides the default text-file source (e.g. ``feed_source(spark, "kafka", ...)``).
    """
    if lines is None:
        lines = feed_source(spark, "text", in_dir, max_files)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        tagged = FD.tag_lines(batch).persist()  # one parse; every table takes its elements from it
        # record types present in this batch (at most a dozen codes) decide which tables to write
        present = {r[0] for r in tagged.select("tag").distinct().collect()}
        for name, df in FD.split_feed(tagged).items():
            if not present & set(FD.TABLES.get(name, ("reject",))):
                continue
            if name in ("trades", "stock_summary"):
                append(df.drop("received_at"), f"{out_base}/{name}", name, batch_id=epoch, run=run)
            elif name == "orderbook":
                append(df.withColumn("book_date", F.to_date("ts")), f"{out_base}/{name}",
                       partition_by=["book_date"], batch_id=epoch, run=run)
            else:
                append(df, f"{out_base}/{name}", batch_id=epoch, run=run)
        tagged.unpersist()

    w = lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


# --- T-02 dedupe of re-sent trades --------------------------------------------------------

def dedupe_stream(trades: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Drop re-sent trades (same ``trade_no``) arriving within ``lateness`` of the original."""
    t = with_event_time(trades)
    return t.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["trade_no"]).drop("event_time")


def trade_records(tagged: DataFrame) -> DataFrame:
    """Live trades (type 1) and their end-of-day resend (type 8) as rows of one schema;
    ``record`` is the type, which decides whose value counts."""
    live = FD.feed_trades(tagged).drop("received_at").withColumn("record", F.lit(1))
    eod = FD.feed_trades_eod(tagged).drop("received_at").withColumns(
        {"trade_date": F.date_format("trade_date", "yyyyMMdd"), "record": F.lit(8)})
    return eod.unionByName(live, allowMissingColumns=True)


def reconcile_sink(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` for feed lines: each trade once, completed by its end-of-day resend.

    A watermark that waits for the resend would have to keep a day of trades as state and
    still drop what comes later. Here the table is the state: a batch's records are merged
    by (day, trade number) into the partitions of their days, so a resend hours or days
    later fills in brokers, investor types and order numbers, adds trades that were missed
    live, and repeats nothing."""
    from bursa.sources.sinks import merge_records

    def _write(batch: DataFrame, _epoch: int) -> None:
        tagged = FD.tag_lines(batch, ("1", "8"))
        merge_records(trade_records(tagged), path, ["trade_date", "trade_no"], ["trade_date"], "record")
    return _write


# --- T-03 live latest snapshot ------------------------------------------------------------

def latest_snapshot_stream(summary: DataFrame) -> DataFrame:
    """Latest snapshot per symbol as a streaming aggregate (update mode)."""
    cols = [c for c in summary.columns if c != "security_code"]
    order = F.struct("ts", "data_date")
    agg = summary.groupBy("security_code").agg(F.max_by(F.struct(*cols), order).alias("s"))
    return agg.select("security_code", *[F.col(f"s.{c}").alias(c) for c in cols])


# --- T-04 daily OHLC rollup ------------------------------------------------------------------

def daily_ohlc_stream(trades: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Tumbling one-day bars per symbol from the trade stream (feeds ``daily_ohlc``)."""
    t = with_event_time(trades).withWatermark("event_time", lateness)
    order = F.struct("ts", "trade_no")
    g = t.groupBy(F.window("event_time", "1 day").alias("w"), "security_code").agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", order).alias("close"), F.sum("volume").alias("volume"),
        F.sum(F.col("price") * F.col("volume")).alias("__value"))
    return g.select(wall_clock("w.start").alias("bucket"), "security_code", "open", "high", "low",
                    "close", "volume", F.round("__value", 0).cast("bigint").alias("value"))


# --- T-05 top movers per minute ------------------------------------------------------------

def in_session(summary: DataFrame, session: tuple[int, int] | None = K.MOVERS_SESSION) -> DataFrame:
    """Snapshots of the minutes for which movers are listed (both ends in; None: all)."""
    minute = F.hour("ts") * 60 + F.minute("ts")
    return summary if session is None else summary.where(minute.between(*session))


def minute_change_stream(summary: DataFrame, lateness: str = "10 minutes",
                         session: tuple[int, int] | None = K.MOVERS_SESSION) -> DataFrame:
    """Per minute and symbol: the last snapshot's percent change against the previous price."""
    s = with_event_time(in_session(summary, session)).withWatermark("event_time", lateness)
    g = s.groupBy(F.window("event_time", "1 minute").alias("w"), "security_code").agg(
        F.max_by(F.struct("close_price", "previous_price"), F.struct("ts", "data_date")).alias("s"))
    return g.select(wall_clock("w.start").alias("minute"),
                    F.to_date(wall_clock("w.start")).alias("minute_day"), "security_code",
                    F.col("s.close_price").alias("close_price"), F.col("s.previous_price").alias("previous_price"))


def rank_movers(minute_changes: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` gainers and losers of every minute (rank within the minute)."""
    c = minute_changes.where(F.col("previous_price") > 0).withColumn(
        "__chg", guarded_ratio(F.col("close_price") - F.col("previous_price"), "previous_price"))
    out = []
    for kind, order in (("top_gainer", F.col("__chg").desc()), ("top_loser", F.col("__chg").asc())):
        w = Window.partitionBy("minute").orderBy(order, "security_code")
        out.append(c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
                    .select(F.lit(kind).alias("kind"), "minute", "rank", "security_code",
                            pct_change("close_price", "previous_price").alias("pct_change")))
    return out[0].unionByName(out[1])


def movers_sink(minutes_path: str, ranks_path: str, n: int = 10) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` for the minute changes: keep them, and rank only the minutes that
    the batch touched, reading their days' partitions alone.

    A minute's symbols only grow in number, so its new ranks replace all stored ones."""
    def _write(batch: DataFrame, _epoch: int) -> None:
        rows = batch.persist()
        if rows.isEmpty():
            rows.unpersist()
            return
        upsert(rows, minutes_path, keys=["minute", "security_code"], partition_by=["minute_day"])
        touched = rows.select("minute").distinct()
        days = rows.select(F.collect_set("minute_day")).scalar()  # bounded by the calendar
        stored = batch.sparkSession.read.schema(rows.schema).parquet(minutes_path)
        stored = stored.where(F.array_contains(days, F.col("minute_day"))).join(touched, "minute", "left_semi")
        ranks = rank_movers(stored, n).withColumn("minute_day", F.to_date("minute"))
        upsert(ranks, ranks_path, keys=["minute_day", "minute", "kind", "rank"], partition_by=["minute_day"])
        rows.unpersist()
    return _write


def replay(df: DataFrame, path: str, time_col: str, chunks: int = 4, fmt: str = "parquet",
           files: int = 16, after: Callable[[], None] | None = None) -> None:
    """Write ``df`` as ``chunks`` successive appends in ``time_col`` order, so a file
    stream source sees the data in arrival order (one file set per chunk).

    The rows are made once and stored, then each chunk is written in at most ``files`` files,
    so a stream takes a chunk as one batch whatever the size; rows without a time come
    with the last chunk. The chunks' bounds split the time range evenly. ``after`` is called
    when a chunk has been written: a stream that goes on there meets each chunk in a batch of
    its own, so no row comes behind a watermark that later rows of its own chunk have moved."""
    staged = f"{path.rstrip('/')}-rows"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(staged)
    df = df.sparkSession.read.schema(df.schema).parquet(staged)
    bounds = df.agg(F.min(time_col).cast("timestamp_ntz").alias("lo"),
                    F.max(time_col).cast("timestamp_ntz").alias("hi")).first()
    chunk = F.lit(chunks - 1)
    if bounds.lo is not None:
        span = (bounds.hi - bounds.lo) / chunks
        for i in range(chunks - 1, 0, -1):
            chunk = F.when(F.col(time_col) < F.lit(bounds.lo + span * i), i - 1).otherwise(chunk)
    for i in range(chunks):
        part = df.where(chunk == i).coalesce(files)
        (part.select("value").write.mode("append").text if fmt == "text" else part.write.mode("append").parquet)(path)
        if after is not None:
            after()


# --- sinks ------------------------------------------------------------------------------------

def upsert_sink(path: str, keys: list[str], partition_by: list[str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function merging each batch's updated rows into a keyed table."""
    def _write(batch: DataFrame, _epoch: int) -> None:
        upsert(batch, path, keys=keys, partition_by=partition_by)
    return _write


def run_to_table(stream: DataFrame, path: str, keys: list[str], partition_by: list[str], checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """Start ``stream`` in update mode, upserting into ``path``."""
    return (stream.writeStream.outputMode("update").foreachBatch(upsert_sink(path, keys, partition_by))
                  .option("checkpointLocation", checkpoint)
                  .trigger(**(trigger or {"availableNow": True})).start())


# --- T-06 nightly state from a stream -------------------------------------------------------

def sideways_state_sink(daily_path: str, state_path: str, days: int = K.SIDEWAYS_DAYS_NIGHTLY,
                        **params) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` for the daily-bar stream: merge the bars, then renew the state of
    every symbol-day whose frame holds a bar of the batch.

    A bar of day d is in the frames of its symbol's next ``days`` days, so one that comes
    late renews the state from d to d + ``days`` and no other. Their frames reach back
    ``days`` more; only the months between those ends are read, for the batch's symbols.
    The batch's keys run along with the bars as rows without values, which no frame counts,
    so one shuffle by symbol tells the days to renew and makes their state.
    After any order of arrival the state equals the batch result over all bars."""
    from bursa.plans.sideways import sideways_state, store_sideways

    def _write(batch: DataFrame, _epoch: int) -> None:
        rows = batch.withColumn("bucket_month", F.date_format("bucket", "yyyy-MM")).persist()
        upsert(rows, daily_path, keys=["security_code", "bucket"], partition_by=["bucket_month"])
        ends = rows.agg(F.date_format(F.date_sub(F.to_date(F.min("bucket")), days), "yyyy-MM").alias("lo"),
                        F.date_format(F.date_add(F.to_date(F.max("bucket")), days), "yyyy-MM").alias("hi")).first()
        if ends.lo is not None:
            bars = batch.sparkSession.read.schema(rows.schema).parquet(daily_path)
            bars = bars.where(F.col("bucket_month").between(ends.lo, ends.hi)) \
                .join(rows.select("security_code").distinct(), "security_code", "left_semi").drop("bucket_month")
            came = rows.where("security_code IS NOT NULL AND bucket IS NOT NULL").select("security_code", "bucket")
            both = bars.withColumn("came", F.lit(False)).unionByName(
                came.withColumn("came", F.lit(True)), allowMissingColumns=True)
            state = sideways_state(both, days=days, last_day_only=False, renewed="came", **params)
            store_sideways(state, state_path)
        rows.unpersist()
    return _write


__all__ = ["replay", "trade_records", "reconcile_sink", "movers_sink", "in_session", "feed_source", "stream_feed", "dedupe_stream", "latest_snapshot_stream", "daily_ohlc_stream",
           "minute_change_stream", "rank_movers", "upsert_sink", "run_to_table", "sideways_state_sink",
           "PARTITION_COLUMNS"]
