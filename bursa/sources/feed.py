"""Exchange feed lines -> market tables (A-10..A-20).

A feed line is ``ANTR|<type>|<fields...>``. Every parser takes a DataFrame with a
string column ``value`` (``spark.read.text`` or ``spark.readStream.text``) and
returns typed rows, so one code path serves batch and Structured Streaming. Any
other columns of the input (e.g. ``received_at``) are carried through.

All parsers read one projection, ``tag_lines``: a line is split and checked once and
becomes an array of tagged elements -- one for a fixed record, one per level of a book
line, one per code of a list line, or one reject with its reason -- that ``inline`` fans
out. Every line therefore gives either records or exactly one reject, which
``feed_conservation`` counts. The fields of each record type stand in one table of
checks that a single expression applies to every line, so parsing stays one pass
whatever the number of record types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bursa.sources.schemas import PRICE

# Fixed values of the wire format: record type codes and the field count of each
# fixed-width record (prefix and type included).
TYPES = {"1": "trade", "2": "stock_summary", "3": "best_bid", "4": "best_offer", "5": "top_gainer",
         "6": "top_loser", "7": "most_active", "8": "trade_eod", "9": "index", "A": "stock",
         "B": "broker", "C": "book_summary"}
FIELD_COUNTS = {"1": 9, "2": 14, "8": 16, "9": 20, "A": 15, "B": 5, "C": 7}
INVESTOR_TYPES = ("I", "A", "S", "F")

# What each field after the type must be: s text, k key text (not empty), l bigint, i int, p price,
# q decimal(20,2), d double, v investor type, o price or empty, t date whose time is a field further on.
CHECKS = {"1": "tskslpl", "2": "tskspppplllo", "8": "lissvsvklptlls", "9": "ktsqqqqqqqlldiiiid", "A": "ksisspqllissl",
          "B": "ksi", "C": "kllll"}
assert {t: len(c) + 2 for t, c in CHECKS.items()} == FIELD_COUNTS


def _fits(check: Column, x: Column, time: Column) -> Column:
    """Whether a field is what its check asks for; ``time`` is the line's date and time."""
    return (F.when(check == "s", True).when(check == "k", x != "")
            .when(check == "l", x.try_cast("bigint").isNotNull()).when(check == "i", x.try_cast("int").isNotNull())
            .when(check == "p", x.try_cast(PRICE).isNotNull())
            .when(check == "q", x.try_cast("decimal(20,2)").isNotNull())
            .when(check == "d", x.try_cast("double").isNotNull()).when(check == "v", x.isin(*INVESTOR_TYPES))
            .when(check == "o", (x == "") | x.try_cast(PRICE).isNotNull()).otherwise(time.isNotNull()))


def _line_time() -> Column:
    """Date and time of the record types that have one (8 and 9 at other places than 1 and 2)."""
    def at(day: int, clock: int, form: str) -> Column:
        return F.try_to_timestamp(F.concat(F.get("__p", F.lit(day)), F.get("__p", F.lit(clock))), F.lit(form))

    kind = F.get("__p", F.lit(1))
    return F.when(kind.isin("1", "2"), at(2, 3, "yyyyMMddHHmmss")).when(kind == "9", at(3, 4, "yyyyMMddHHmmss")) \
        .when(kind == "8", at(12, 15, "yyyy-MM-ddHHmmss"))


def _elements() -> Column:
    """The tagged elements of a line: array of (tag, pos, fields, reason)."""
    p, n, kind = F.col("__p"), F.size("__p"), F.coalesce(F.get("__p", F.lit(1)), F.lit(""))
    body = F.slice(p, 3, n)
    table = F.create_map(*[x for t, c in CHECKS.items() for x in (F.lit(t), F.array(*map(F.lit, c)))])
    checks = F.try_element_at(table, kind)
    fits = F.zip_with(body, checks, lambda x, c: _fits(c, x, F.col("__time")))
    code = F.get(p, F.lit(2))  # of a book line; read in place, as each level needs it
    key = F.when(kind.isin("3", "4"), code).otherwise(F.get(body, F.array_position(checks, "k").cast("int") - 1))
    book, ranks = kind.isin("3", "4"), kind.isin("5", "6", "7")
    levels = F.split(F.regexp_replace(F.array_join(F.slice(p, 4, n), "|"), r"^\{[01]\}", ""), r"\|")
    items = F.filter(F.when(book, levels).when(ranks, body), lambda x: x != "")

    def element(tag: Column, pos: Column, fields: Column) -> Column:
        return F.struct(tag.alias("tag"), pos.cast("int").alias("pos"), fields.alias("fields"),
                        F.lit(None).cast("string").alias("reason"))

    def reject(reason: str) -> Column:
        return F.array(F.struct(F.lit("reject").alias("tag"), F.lit(0).alias("pos"),
                                F.lit(None).cast("array<string>").alias("fields"), F.lit(reason).alias("reason")))

    def good_level(x: Column) -> Column:
        g = F.split(x, ";")
        return ((F.size(g) == 3) & F.get(g, F.lit(0)).try_cast("int").isNotNull()
                & F.get(g, F.lit(1)).try_cast(PRICE).isNotNull() & F.get(g, F.lit(2)).try_cast("bigint").isNotNull())

    return (F.when(F.get(p, F.lit(0)) != "ANTR", reject("bad prefix"))
            .when(~kind.isin(*TYPES), reject("unknown type"))
            .when(F.when(book, n < 4).when(ranks, n < 3).otherwise(n != F.size(checks) + 2), reject("field count"))
            .when(~ranks & (key == ""), reject("empty code"))
            .when((book | ranks) & (F.size(items) == 0), reject("no element"))
            .when(ranks, F.transform(items, lambda x, i: element(kind, i, F.array(x))))
            .when(book & F.forall(items, good_level),
                  F.transform(items, lambda x, i: element(kind, i, F.concat(F.array(code), F.split(x, ";")))))
            .when(~book & F.forall(fits, lambda x: x), F.array(element(kind, F.lit(0), p)))
            .otherwise(reject("bad value")))


def tag_lines(lines: DataFrame, types=None) -> DataFrame:
    """The one parse of a feed: per element of a line its columns, ``tag`` (the record
    type, or ``reject``), ``pos`` (place in its line), ``fields`` and ``reason``.

    ``types`` keeps the lines of these record types only. A null line is a line with a
    bad prefix."""
    out = lines.withColumn("__p", F.split(F.coalesce("value", F.lit("")), r"\|", -1))
    if types is not None:
        out = out.where(F.get("__p", F.lit(1)).isin(*types))
    return out.withColumn("__time", _line_time()).select(*lines.columns, F.inline(_elements()))


def _f(i: int) -> Column:
    """A field of the line; NULL beyond its last one."""
    return F.get("fields", F.lit(i))


def _ts(date_col: Column, time_col: Column, fmt: str = "yyyyMMddHHmmss") -> Column:
    return F.try_to_timestamp(F.concat(date_col, time_col), F.lit(fmt)).cast("timestamp_ntz")


def _opt(i: int, dtype) -> Column:
    """Optional field: empty text is NULL, anything else must cast."""
    return F.when(_f(i) == "", F.lit(None).cast(dtype)).otherwise(_f(i).try_cast(dtype))


# Field layout of each fixed-width record: output name -> (position, parsed value).
def _trade_fields():
    return {"trade_no": (6, _f(6).try_cast("bigint")), "trade_date": (2, _f(2)), "trade_time": (3, _f(3)),
            "ts": (2, _ts(_f(2), _f(3))), "security_code": (4, _f(4)), "board_code": (5, _f(5)),
            "price": (7, _f(7).try_cast(PRICE)), "volume": (8, _f(8).try_cast("bigint"))}


def _summary_fields():
    return {"data_date": (2, _f(2)), "data_time": (3, _f(3)), "ts": (2, _ts(_f(2), _f(3))),
            "security_code": (4, _f(4)), "board_code": (5, _f(5)),
            "opening_price": (6, _f(6).try_cast(PRICE)), "highest_price": (7, _f(7).try_cast(PRICE)),
            "lowest_price": (8, _f(8).try_cast(PRICE)), "close_price": (9, _f(9).try_cast(PRICE)),
            "trade_volume": (10, _f(10).try_cast("bigint")), "trade_value": (11, _f(11).try_cast("bigint")),
            "trade_frequency": (12, _f(12).try_cast("bigint")), "previous_price": (13, _opt(13, PRICE))}


def _eod_fields():
    inv = lambda c: F.when(c.isin(*INVESTOR_TYPES), c)
    return {"trade_no": (2, _f(2).try_cast("bigint")), "session": (3, _f(3).try_cast("int")),
            "board_code": (4, _f(4)), "seller_broker": (5, _f(5)), "seller_investor_type": (6, inv(_f(6))),
            "buyer_broker": (7, _f(7)), "buyer_investor_type": (8, inv(_f(8))), "security_code": (9, _f(9)),
            "volume": (10, _f(10).try_cast("bigint")), "price": (11, _f(11).try_cast(PRICE)),
            "trade_date": (12, F.try_to_timestamp(_f(12), F.lit("yyyy-MM-dd")).cast("date")),
            "seller_order_no": (13, _f(13).try_cast("bigint")), "buyer_order_no": (14, _f(14).try_cast("bigint")),
            "trade_time": (15, _f(15)), "ts": (12, _ts(_f(12), _f(15), "yyyy-MM-ddHHmmss"))}


def _index_fields():
    lvl = "decimal(20,2)"
    names = ["last_index", "prev_index", "open_index", "high_index", "low_index", "change", "change_rate"]
    out = {"index_code": (2, _f(2)), "data_date": (3, _f(3)), "data_time": (4, _f(4)),
           "ts": (3, _ts(_f(3), _f(4)))}
    out.update({n: (5 + i, _f(5 + i).try_cast(lvl)) for i, n in enumerate(names)})
    out.update({"frequency": (12, _f(12).try_cast("bigint")), "volume_lots": (13, _f(13).try_cast("bigint")),
                "value": (14, _f(14).try_cast("double")), "up": (15, _f(15).try_cast("int")),
                "down": (16, _f(16).try_cast("int")), "unchanged": (17, _f(17).try_cast("int")),
                "no_transaction": (18, _f(18).try_cast("int")), "market_value": (19, _f(19).try_cast("double"))})
    return out


def _stock_fields():
    return {"security_code": (2, _f(2)), "security_name": (3, _f(3)),
            "security_status": (4, _f(4).try_cast("int")), "security_type": (5, _f(5)),
            "sub_industry": (6, _f(6)), "ipo_price": (7, _f(7).try_cast(PRICE)),
            "base_price": (8, _f(8).try_cast("decimal(20,2)")), "listed_shares": (9, _f(9).try_cast("bigint")),
            "tradable_listed_shares": (10, _f(10).try_cast("bigint")),
            "shares_per_lot": (11, _f(11).try_cast("int")), "remarks": (12, _opt(12, "string")),
            "security_remarks2": (13, _opt(13, "string")), "weight": (14, _f(14).try_cast("bigint"))}


def _broker_fields():
    return {"broker_code": (2, _f(2)), "broker_name": (3, _f(3)), "broker_status": (4, _f(4).try_cast("int"))}


def _book_summary_fields():
    return {"security_code": (2, _f(2)), "total_bid_queue": (3, _f(3).try_cast("bigint")),
            "total_bid_volume": (4, _f(4).try_cast("bigint")), "total_offer_queue": (5, _f(5).try_cast("bigint")),
            "total_offer_volume": (6, _f(6).try_cast("bigint"))}


FIELDS = {"1": _trade_fields, "2": _summary_fields, "8": _eod_fields, "9": _index_fields,
          "A": _stock_fields, "B": _broker_fields, "C": _book_summary_fields}


def _is_tagged(lines: DataFrame) -> bool:
    return {"tag", "pos", "fields", "reason"} <= set(lines.columns)


def _tagged(lines: DataFrame, *types: str) -> DataFrame:
    """The elements of these record types, from lines or from an earlier ``tag_lines``."""
    tagged = lines if _is_tagged(lines) else tag_lines(lines, types)
    return tagged.where(F.col("tag").isin(*types))


def _carried(tagged: DataFrame) -> list[str]:
    return [c for c in tagged.columns if c not in ("value", "tag", "pos", "fields", "reason")]


def _typed(lines: DataFrame, type_code: str) -> DataFrame:
    rows = _tagged(lines, type_code)
    return rows.select(*_carried(rows), *[v.alias(n) for n, (_, v) in FIELDS[type_code]().items()])


def feed_trades(lines: DataFrame) -> DataFrame:
    """Type 1 -> ``trades`` rows (A-11). ``ts`` is the trade date and time."""
    return _typed(lines, "1")


def feed_summary(lines: DataFrame) -> DataFrame:
    """Type 2 -> ``stock_summary`` rows (A-12); an empty previous price is NULL."""
    return _typed(lines, "2")


def feed_trades_eod(lines: DataFrame) -> DataFrame:
    """Type 8 -> end-of-day trades with brokers, investor types (I/A/S/F) and order numbers (A-15)."""
    return _typed(lines, "8")


def feed_index(lines: DataFrame) -> DataFrame:
    """Type 9 -> index snapshots (A-16); value and market value accept E-notation."""
    return _typed(lines, "9")


def feed_stock_master(lines: DataFrame) -> DataFrame:
    """Type A -> stock master rows (A-17); zero-padded numbers cast directly."""
    return _typed(lines, "A")


def feed_brokers(lines: DataFrame) -> DataFrame:
    """Type B -> broker master rows (A-18)."""
    return _typed(lines, "B")


def feed_book_summary(lines: DataFrame) -> DataFrame:
    """Type C -> order-book totals per security (A-19)."""
    return _typed(lines, "C")


def feed_rejects(lines: DataFrame) -> DataFrame:
    """Lines no parser accepts, with the reason (A-20), each once: bad prefix, unknown
    type, field count, empty code, no element (a list or book line that holds none), or
    bad value."""
    tagged = lines if _is_tagged(lines) else tag_lines(lines)
    return tagged.where(F.col("tag") == "reject").select(*[c for c in tagged.columns if c not in ("tag", "pos", "fields")])


def feed_conservation(lines: DataFrame) -> DataFrame:
    """Per record type (``reject`` for rejects): lines and rows; lines add up to the input."""
    return tag_lines(lines).groupBy("tag").agg(
        F.count_if(F.col("pos") == 0).alias("n_lines"), F.count(F.lit(1)).alias("n_rows"))


def feed_orderbook(lines: DataFrame, received_at: Column | str = "received_at",
                   rank_by_price: bool = False) -> DataFrame:
    """Types 3 (bid) / 4 (offer) -> ``orderbook`` rows, one per queued level (A-13).

    The wire has no time, so ``ts`` is the arrival time column. Levels follow the
    message order (plus an optional ``level_offset`` column when a deep book arrives
    in several messages); ``rank_by_price`` re-ranks them (bids high->low, offers
    low->high).
    """
    rows = _tagged(lines, "3", "4")
    recv = F.col(received_at) if isinstance(received_at, str) else received_at
    offset = F.col("level_offset") if "level_offset" in rows.columns else F.lit(0)
    keep = [c for c in _carried(rows) if c not in (received_at, "level_offset")]
    out = rows.select(*keep, recv.alias("ts"), _f(0).alias("security_code"),
                      F.when(F.col("tag") == "3", F.lit("B")).otherwise(F.lit("O")).alias("side"),
                      (offset + F.col("pos") + 1).cast("int").alias("level"), _f(1).try_cast("int").alias("frequency"),
                      _f(2).try_cast(PRICE).alias("price"), _f(3).try_cast("bigint").alias("volume"))
    if rank_by_price:
        from bursa.operators.latest import exact_rank
        signed = F.when(F.col("side") == "B", -F.col("price")).otherwise(F.col("price"))
        out = exact_rank(out.withColumns({"__signed": signed, "__msg_level": F.col("level")}),
                         ["security_code", "ts", "side"], ["__signed", "__msg_level"], "level")
        out = out.drop("__signed", "__msg_level")
    return out


def feed_rank_lists(lines: DataFrame) -> DataFrame:
    """Types 5/6/7 -> (kind, rank, security_code) (A-14)."""
    rows = _tagged(lines, "5", "6", "7")
    kind = (F.when(F.col("tag") == "5", "top_gainer").when(F.col("tag") == "6", "top_loser")
            .otherwise("most_active"))
    return rows.select(*_carried(rows), kind.alias("kind"), (F.col("pos") + 1).cast("int").alias("rank"),
                       _f(0).alias("security_code"))


TABLES = {"trades": ("1",), "stock_summary": ("2",), "orderbook": ("3", "4"), "rank_lists": ("5", "6", "7"),
          "trades_eod": ("8",), "index": ("9",), "stock_master": ("A",), "brokers": ("B",), "book_summary": ("C",)}


def split_feed(lines: DataFrame, path: str | None = None) -> dict[str, DataFrame]:
    """Route a feed by record type (A-10): one typed frame per table, plus rejects.

    With a ``path`` the tagged elements are first written there, partitioned by tag, so
    the lines are read and parsed once and each table reads its own partitions."""
    tagged = lines if _is_tagged(lines) else tag_lines(lines)
    if path is not None:
        tagged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("tag").parquet(path)
        tagged = lines.sparkSession.read.schema(tagged.schema).parquet(path).select(*tagged.columns)
    parsers = {"trades": feed_trades, "stock_summary": feed_summary, "rank_lists": feed_rank_lists,
               "trades_eod": feed_trades_eod, "index": feed_index, "stock_master": feed_stock_master,
               "brokers": feed_brokers, "book_summary": feed_book_summary, "rejects": feed_rejects}
    if "received_at" in lines.columns:
        parsers["orderbook"] = feed_orderbook
    return {name: parse(tagged) for name, parse in parsers.items()}


# --- writers of feed lines (used to replay stored tables as a feed) ----------------------

def _num(c: Column) -> Column:
    return c.cast("string")


def trade_line() -> Column:
    """The type-1 feed line of a ``trades`` row."""
    return F.concat_ws("|", F.lit("ANTR"), F.lit("1"), "trade_date", "trade_time", "security_code", "board_code",
                       F.lpad(_num(F.col("trade_no")), 12, "0"), _num(F.col("price")), _num(F.col("volume")))


def eod_line() -> Column:
    """The type-8 feed line of an end-of-day trade row."""
    return F.concat_ws("|", F.lit("ANTR"), F.lit("8"), *[_num(F.col(c)) for c in (
        "trade_no", "session", "board_code", "seller_broker", "seller_investor_type", "buyer_broker",
        "buyer_investor_type", "security_code", "volume", "price")], F.date_format("trade_date", "yyyy-MM-dd"),
        *[_num(F.col(c)) for c in ("seller_order_no", "buyer_order_no", "trade_time")])


def trades_to_lines(trades: DataFrame) -> DataFrame:
    return trades.select(trade_line().alias("value"))


def summary_to_lines(summary: DataFrame) -> DataFrame:
    return summary.select(F.concat_ws(
        "|", F.lit("ANTR"), F.lit("2"), "data_date", "data_time", "security_code", "board_code",
        *[_num(F.col(c)) for c in ("opening_price", "highest_price", "lowest_price", "close_price", "trade_volume",
                                   "trade_value", "trade_frequency")],
        F.coalesce(_num(F.col("previous_price")), F.lit(""))).alias("value"))


def orderbook_to_lines(book: DataFrame, max_levels: int = 100) -> DataFrame:
    """Feed lines of a stored book: one message per (security, time, side) and block of
    ``max_levels`` levels, with ``received_at`` = ts and the block's ``level_offset``.
    Blocks keep every level while bounding the rows gathered into one message."""
    grp = F.concat_ws(";", _num(F.col("frequency")), _num(F.col("price")), _num(F.col("volume")))
    blk = F.floor((F.col("level") - 1) / F.lit(max_levels)).cast("int")
    g = book.withColumn("__blk", blk).groupBy("security_code", "ts", "side", "__blk").agg(
        F.array_sort(F.collect_list(F.struct("level", grp.alias("g")))).alias("__lv"))
    body = F.array_join(F.transform("__lv", lambda x: x["g"]), "|")
    typ = F.when(F.col("side") == "B", F.lit("3")).otherwise(F.lit("4"))
    tag = F.when(F.col("side") == "B", F.lit("{0}")).otherwise(F.lit("{1}"))
    return g.select(F.concat(F.lit("ANTR|"), typ, F.lit("|"), F.col("security_code"), F.lit("|"), tag, body,
                             F.lit("|")).alias("value"), F.col("ts").alias("received_at"),
                    (F.col("__blk") * max_levels).cast("int").alias("level_offset"))
