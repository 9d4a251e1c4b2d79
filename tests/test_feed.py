import datetime as dt
from decimal import Decimal as D

from bursa.sources import feed as FD

LINES = [
    "ANTR|1|20240115|093015|KAVO|RG|000000004101|210.00|1200",
    "ANTR|1|20240115|093016|LUMA|RG|000000004102|515.00|300",
    "ANTR|2|20240115|150510|LUMA|NG|505.0|520.0|500.0|515.0|1250000|640625000|310|510.0",
    "ANTR|2|20240115|150512|PIRA|RG|75.0|78.0|75.0|77.0|40000|3060000|22|",
    "ANTR|3|KAVO|{0}1;195;12|2;200;7|4;205;9|",
    "ANTR|4|LUMA|{1}3;515;20|1;520;8|",
    "ANTR|5|KAVO|LUMA|PIRA|",
    "ANTR|7|PIRA|KAVO|",
    "ANTR|8|7|3|RG|ZA|F|ZB|F|LUMA|300|515|2024-01-15|9001|9002|101500",
    "ANTR|9|TESTIDX|20240115|101500|1000.0|1010.0|1012.0|1020.0|995.0|12.0|1.2|5000|750000|3.25e9|10|8|5|2|1015.5",
    "ANTR|A|PIRA|Pira Test Works|0|ORDI|0011|20.00|00000000000.00|00000000050000|00000000020000|1||----------|0000",
    "ANTR|B|ZA|Test Broker One|0",
    "ANTR|C|KAVO|21|330|14|275",
    # rejects
    "XXXX|1|20240115|093015|KAVO|RG|000000004101|210.00|1200",
    "ANTR|Z|something",
    "ANTR|1|20240115|093015|KAVO|RG|000000004101|210.00",
    "ANTR|1|20240115|093015|KAVO|RG|abc|210.00|1200",
    "ANTR|8|7|4|RG|ZA|Q|ZB|F|LUMA|300|515|2024-01-15|9001|9002|101500",
]


def _lines(spark):
    return spark.createDataFrame([(x, dt.datetime(2024, 1, 15, 14, 50)) for x in LINES],
                                 "value string, received_at timestamp_ntz")


def test_trades_and_summary(spark):
    t = {r.trade_no: r for r in FD.feed_trades(_lines(spark)).collect()}
    assert set(t) == {4101, 4102}
    assert t[4101].price == D("210.00") and t[4101].ts == dt.datetime(2024, 1, 15, 9, 30, 15)
    s = {r.security_code: r for r in FD.feed_summary(_lines(spark)).collect()}
    assert s["LUMA"].trade_value == 640625000 and s["PIRA"].previous_price is None


def test_orderbook_levels(spark):
    b = FD.feed_orderbook(_lines(spark)).collect()
    bids = sorted((r.level, r.price) for r in b if r.side == "B")
    offers = [r for r in b if r.side == "O"]
    assert len(bids) == 3 and bids[0] == (1, D("195.00")) and len(offers) == 2
    ranked = [r for r in FD.feed_orderbook(_lines(spark), rank_by_price=True).collect() if r.side == "B"]
    assert min(ranked, key=lambda r: r.level).price == D("205.00")


def test_rank_lists_and_masters(spark):
    r = FD.feed_rank_lists(_lines(spark)).collect()
    assert len(r) == 5 and {x.kind for x in r} == {"top_gainer", "most_active"}
    e = FD.feed_trades_eod(_lines(spark)).collect()
    assert len(e) == 1 and e[0].buyer_investor_type == "F" and e[0].trade_date == dt.date(2024, 1, 15)
    i = FD.feed_index(_lines(spark)).first()
    assert i.value == 3.25e9 and i.change == D("12.00")
    a = FD.feed_stock_master(_lines(spark)).first()
    assert a.listed_shares == 50000 and a.remarks is None
    assert FD.feed_brokers(_lines(spark)).first().broker_name == "Test Broker One"
    assert FD.feed_book_summary(_lines(spark)).first().total_offer_volume == 275


def test_rejects_reasons(spark):
    got = sorted(r.reason for r in FD.feed_rejects(_lines(spark)).collect())
    assert got == ["bad prefix", "bad value", "bad value", "field count", "unknown type"]


def test_roundtrip_writers(spark):
    t = FD.feed_trades(_lines(spark))
    back = FD.feed_trades(FD.trades_to_lines(t.drop("received_at")))
    assert back.exceptAll(t.drop("received_at")).count() == 0


def test_free_float_from_stock_master(spark):
    from bursa.plans.swing import free_float_from_master
    ff = free_float_from_master(FD.feed_stock_master(_lines(spark))).first()
    assert ff.code == "PIRA" and ff.free_float_pct == 40.0


def test_every_malformed_line_is_rejected_once(spark):
    lines = ["", "ANTR", "no pipe", "ANTR|3|AAAA", "ANTR|3|AAAA|{0}x;10;5|1;11;6|", "ANTR|5", "ANTR|Z|a", "|1|"]
    got = {r.value: r.reason for r in FD.feed_rejects(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert got == {"": "bad prefix", "ANTR": "unknown type", "no pipe": "bad prefix", "ANTR|3|AAAA": "field count",
                   "ANTR|3|AAAA|{0}x;10;5|1;11;6|": "bad value", "ANTR|5": "field count", "ANTR|Z|a": "unknown type",
                   "|1|": "bad prefix"}


def test_deep_book_line_keeps_all_levels(spark):
    line = "ANTR|3|AAAA|{0}" + "|".join(f"1;{k};2" for k in range(1, 100_051)) + "|"
    df = spark.createDataFrame([(line,)], "value string").selectExpr("value", "timestamp_ntz'2024-01-01 10:00:00' received_at")
    assert FD.feed_orderbook(df).count() == 100_050 and FD.feed_rejects(df.drop("received_at")).count() == 0


def test_a_batch_written_twice_counts_once(spark, tmp_path):
    from bursa.sources.sinks import append
    t = FD.feed_trades(_lines(spark)).drop("received_at")
    for batch in (0, 1, 1):
        append(t, f"{tmp_path}/trades", "trades", batch_id=batch)
    assert spark.read.parquet(f"{tmp_path}/trades").count() == 2 * t.count()


def test_lines_without_content_are_rejected(spark):
    lines = ["ANTR|5|", "ANTR|7||||", "ANTR|3|AAAA|", "ANTR|3|AAAA|{0}", "ANTR|3||{0}1;2;3|", "ANTR|C||1|2|3|4",
             "ANTR|4|AAAA|{1}1;2;3|", "ANTR|6|AAAA||BBBB|"]
    df = spark.createDataFrame([(x,) for x in [*lines, None]], "value string")
    got = {r.value: r.reason for r in FD.feed_rejects(df).collect()}
    assert got == {"ANTR|5|": "no element", "ANTR|7||||": "no element", "ANTR|3|AAAA|": "no element",
                   "ANTR|3|AAAA|{0}": "no element", "ANTR|3||{0}1;2;3|": "empty code", "ANTR|C||1|2|3|4": "empty code",
                   None: "bad prefix"}
    ranks = [(r.rank, r.security_code) for r in FD.feed_rank_lists(df).collect()]
    assert sorted(ranks) == [(1, "AAAA"), (2, "BBBB")]


def test_every_line_is_parsed_or_rejected_in_one_pass(spark, tmp_path):
    lines = _lines(spark)
    count = {r.tag: (r.n_lines, r.n_rows) for r in FD.feed_conservation(lines).collect()}
    assert sum(n for n, _ in count.values()) == len(LINES) and count["reject"] == (5, 5) and count["3"] == (1, 3)
    apart, stored = FD.split_feed(lines), FD.split_feed(lines, f"{tmp_path}/tagged")
    for name, df in stored.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, apart[name].collect())), name
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "PartitionFilters: [tag#" in plan or "isnotnull(tag#" in plan
    assert sum(df.count() for df in apart.values()) == sum(n for _, n in count.values())


def test_two_streams_into_one_table_add_up(spark, tmp_path):
    from bursa.streaming import live
    for k, line in enumerate(LINES[:2]):
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(f"{tmp_path}/in{k}")
        for _ in range(2):  # started again from its checkpoint it adds nothing
            live.stream_feed(spark, f"{tmp_path}/in{k}", f"{tmp_path}/out", f"{tmp_path}/ck{k}").awaitTermination()
    assert sorted(r.trade_no for r in spark.read.parquet(f"{tmp_path}/out/trades").collect()) == [4101, 4102]


def test_resent_trades_are_completed_once(spark, tmp_path):
    from bursa.sources.sinks import merge_records
    from bursa.streaming import live
    eod = "ANTR|8|4101|1|RG|ZA|F|ZB|I|KAVO|1200|210.00|2024-01-15|9001|9002|093015"
    lost = "ANTR|8|4109|1|RG|ZA|F|ZB|I|KAVO|700|211.00|2024-01-15|9003|9004|093016"
    for batch in ([LINES[0], LINES[1], LINES[0]], [eod, lost], [LINES[0]], [eod]):
        tagged = FD.tag_lines(spark.createDataFrame([(x,) for x in batch], "value string"))
        merge_records(live.trade_records(tagged), f"{tmp_path}/t", ["trade_date", "trade_no"], ["trade_date"], "record")
    rows = {r.trade_no: r for r in spark.read.parquet(f"{tmp_path}/t").collect()}
    assert set(rows) == {4101, 4102, 4109} and rows[4101].seller_broker == "ZA" and rows[4102].seller_broker is None
    assert rows[4101].volume == 1200 and rows[4109].price == D("211.00") and rows[4101].record == 8


def test_replay_keeps_rows_without_a_time(spark, tmp_path):
    from bursa.streaming import live
    rows = [(1, dt.datetime(2025, 1, 1)), (2, None), (3, dt.datetime(2025, 1, 3))]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz").repartition(3)
    live.replay(df, f"{tmp_path}/r", "ts", 2)
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/r").collect()) == [1, 2, 3]
    live.replay(df.where("ts IS NULL"), f"{tmp_path}/n", "ts", 2)
    assert spark.read.parquet(f"{tmp_path}/n").count() == 1


def test_replay_makes_rows_once_and_hands_over_chunk_by_chunk(spark, tmp_path):
    """Many input partitions: a chunk has few files, and the stream meets it alone."""
    from bursa.streaming import live
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    start = dt.datetime(2025, 1, 1)
    df = spark.createDataFrame([(k, start + dt.timedelta(minutes=k)) for k in range(400)], "id long, ts timestamp_ntz")
    df = df.repartition(40).mapInArrow(count, "id long, ts timestamp_ntz")
    path, seen = f"{tmp_path}/r", []

    def go_on():
        def sink(batch, _):
            seen.append(sorted(r.id for r in batch.collect()))
        (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 4).parquet(path).writeStream.foreachBatch(sink)
         .option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination())

    live.replay(df, path, "ts", 4, files=4, after=go_on)
    seen = [x for x in seen if x]
    assert made.value == 400 and len(seen) == 4
    assert sum(seen, []) == list(range(400))


def test_upsert_keeps_null_partitions_and_the_callers_cache(spark, tmp_path):
    from bursa.sources.sinks import upsert
    schema = "k string, p string, v int"
    upsert(spark.createDataFrame([("a", None, 1), ("b", "x", 1), (None, "x", 5)], schema), f"{tmp_path}/t", ["k", "p"], ["p"])
    rows = spark.createDataFrame([("c", None, 2), ("b", "x", 2), (None, "x", 6)], schema).persist()
    upsert(rows, f"{tmp_path}/t", ["k", "p"], ["p"])
    assert rows.storageLevel.useMemory
    got = {(r.k, r.p, r.v) for r in spark.read.schema(schema).parquet(f"{tmp_path}/t").collect()}
    assert got == {("a", None, 1), ("c", None, 2), ("b", "x", 2), (None, "x", 6)}
    rows.unpersist()


def test_late_bars_renew_only_their_days(spark, tmp_path):
    from bursa.plans.sideways import read_sideways, sideways_state
    from bursa.sources import adapters as A
    from bursa.streaming import live
    from tests.conftest import SF_SMALL
    bars = A.daily_ohlc(spark, SF_SMALL)
    late = bars.where("pmod(hash(bucket, security_code), 7) = 0")
    write = live.sideways_state_sink(f"{tmp_path}/bars", f"{tmp_path}/state", max_range=20, max_volume=0.5)
    write(bars.exceptAll(late), 0)
    write(late, 1)
    want = sideways_state(bars, 60, max_range=20, max_volume=0.5, last_day_only=False)
    got = read_sideways(spark, f"{tmp_path}/state")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_minute_movers_are_ranked_as_in_batch(spark, tmp_path):
    from pyspark.sql import functions as F

    from bursa.sources import adapters as A
    from bursa.streaming import live
    from tests.conftest import SF_SMALL
    s = A.stock_summary(spark, SF_SMALL)
    write = live.movers_sink(f"{tmp_path}/m", f"{tmp_path}/r", n=2)
    changes = live.minute_change_stream(s)
    for part in (0, 1, 0):  # the last batch is written again
        write(changes.where(F.pmod(F.hash("security_code"), F.lit(2)) == part), part)
    got = spark.read.parquet(f"{tmp_path}/r").drop("minute_day")
    want = live.rank_movers(changes, 2)
    assert got.count() == want.count() > 0 and got.exceptAll(want.select(*got.columns)).count() == 0
    minutes = got.select(F.min(F.hour("minute")), F.max(F.hour("minute") * 60 + F.minute("minute"))).first()
    assert minutes[0] >= 9 and minutes[1] <= 17 * 60
