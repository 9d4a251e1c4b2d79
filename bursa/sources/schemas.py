"""Declared schemas of the market tables and the table scan (A-01..A-07).

Schemas are fixed: no inference and no evolution. ``read_table`` applies the
declared schema at the scan so Parquet column pruning and filter pushdown work,
and ``validate`` checks an in-memory frame against the same declaration.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE = T.DecimalType(12, 2)

STOCK_SUMMARY = T.StructType([
    T.StructField("data_date", T.StringType(), False),
    T.StructField("data_time", T.StringType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("security_code", T.StringType(), False),
    T.StructField("board_code", T.StringType(), False),
    T.StructField("opening_price", PRICE, False),
    T.StructField("highest_price", PRICE, False),
    T.StructField("lowest_price", PRICE, False),
    T.StructField("close_price", PRICE, False),
    T.StructField("trade_volume", T.LongType(), False),
    T.StructField("trade_value", T.LongType(), False),
    T.StructField("trade_frequency", T.LongType(), False),
    T.StructField("previous_price", PRICE, True),
])

TRADES = T.StructType([
    T.StructField("trade_no", T.LongType(), False),
    T.StructField("trade_date", T.StringType(), False),
    T.StructField("trade_time", T.StringType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("security_code", T.StringType(), False),
    T.StructField("board_code", T.StringType(), False),
    T.StructField("price", PRICE, False),
    T.StructField("volume", T.LongType(), False),
])

ORDERBOOK = T.StructType([
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("security_code", T.StringType(), False),
    T.StructField("side", T.StringType(), False),
    T.StructField("level", T.IntegerType(), False),
    T.StructField("frequency", T.IntegerType(), False),
    T.StructField("price", PRICE, False),
    T.StructField("volume", T.LongType(), False),
])

STOCK_FUNDAMENTALS = T.StructType([
    T.StructField("security_code", T.StringType(), False),
    T.StructField("shares_outstanding", T.LongType(), False),
    T.StructField("last_updated", T.DateType(), False),
    T.StructField("source", T.StringType(), True),
])

MARKET_CAP = T.StructType([
    T.StructField("code", T.StringType(), True),
    T.StructField("listed_stocks", T.StringType(), True),
    T.StructField("number_of_listed_shares", T.LongType(), True),
    T.StructField("market_capitalization", T.LongType(), True),  # millions of rupiah
    T.StructField("percentage", T.DecimalType(9, 4), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("year", T.IntegerType(), True),
])

HISTORY_OHLC = T.StructType([
    T.StructField("code", T.StringType(), False),
    T.StructField("trade_date", T.DateType(), False),
    T.StructField("open", PRICE, True),
    T.StructField("high", PRICE, True),
    T.StructField("low", PRICE, True),
    T.StructField("close", PRICE, True),
    T.StructField("volume", T.LongType(), True),
    T.StructField("value", T.LongType(), True),
    T.StructField("freq", T.LongType(), True),
])

DAILY_OHLC = T.StructType([
    T.StructField("bucket", T.TimestampNTZType(), False),
    T.StructField("security_code", T.StringType(), False),
    T.StructField("open", PRICE, True),
    T.StructField("high", PRICE, True),
    T.StructField("low", PRICE, True),
    T.StructField("close", PRICE, True),
    T.StructField("volume", T.LongType(), True),
    T.StructField("value", T.LongType(), True),
])

SIDEWAYS_STATE = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("trade_date", T.DateType(), False),
    T.StructField("range_ratio", T.DoubleType(), True),
    T.StructField("volume_ratio", T.DoubleType(), True),
    T.StructField("is_sideways", T.BooleanType(), True),
])

SCHEMAS: dict[str, T.StructType] = {
    "stock_summary": STOCK_SUMMARY,
    "trades": TRADES,
    "orderbook": ORDERBOOK,
    "stock_fundamentals": STOCK_FUNDAMENTALS,
    "market_cap": MARKET_CAP,
    "history_ohlc": HISTORY_OHLC,
    "daily_ohlc": DAILY_OHLC,
    "sideways_state": SIDEWAYS_STATE,
}

# Key of each table (from the declared primary keys / conflict targets).
KEYS: dict[str, list[str]] = {
    "stock_summary": ["security_code", "ts"],
    "trades": ["trade_no"],
    "orderbook": ["security_code", "ts", "side", "level"],
    "stock_fundamentals": ["security_code"],
    "market_cap": ["code", "year", "month"],
    "history_ohlc": ["code", "trade_date"],
    "daily_ohlc": ["security_code", "bucket"],
    "sideways_state": ["symbol", "trade_date"],
}

# Partition column used when a table is written (date-grain pruning).
PARTITION_COLUMNS: dict[str, list[str]] = {
    "stock_summary": ["data_date"],
    "trades": ["trade_date"],
    "orderbook": ["book_date"],
    "history_ohlc": ["trade_year"],
    "sideways_state": ["trade_date"],
}

# Partition columns that are no column of the table but follow from one.
DERIVED = {"book_date": T.StructField("book_date", T.DateType(), True),
           "trade_year": T.StructField("trade_year", T.IntegerType(), True)}
_DERIVE = {"book_date": lambda: F.to_date("ts"), "trade_year": lambda: F.year("trade_date")}

# The symbol column, by which stored tables can be bucketed.
SYMBOL = {"stock_summary": "security_code", "trades": "security_code", "orderbook": "security_code",
          "stock_fundamentals": "security_code", "market_cap": "code", "history_ohlc": "code",
          "daily_ohlc": "security_code", "sideways_state": "symbol"}


def with_partitions(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the partition columns that follow from its own."""
    derived = [c for c in PARTITION_COLUMNS.get(name, ()) if c in DERIVED and c not in df.columns]
    return df.withColumns({c: _DERIVE[c]() for c in derived}) if derived else df


def stored_schema(name: str) -> T.StructType:
    """The table's columns and its derived partition columns."""
    return T.StructType(SCHEMAS[name].fields + [DERIVED[c] for c in PARTITION_COLUMNS.get(name, ()) if c in DERIVED])


def read_table(spark: SparkSession, name: str, path: str, partitions: bool = False) -> DataFrame:
    """Scan a stored table with its declared schema (A-01..A-06), without other folder
    columns (a stream's batches); ``partitions`` adds the derived partition columns, by
    which last-day screens prune."""
    schema = stored_schema(name) if partitions else SCHEMAS[name]
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def validate(df: DataFrame, name: str) -> DataFrame:
    """Check column names and types against the declaration and reorder.

    Raises ``ValueError`` listing missing or mistyped columns.
    """
    schema = SCHEMAS[name]
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        if f.name not in have:
            problems.append(f"missing {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    if problems:
        raise ValueError(f"{name}: " + "; ".join(problems))
    return df.select(*[f.name for f in schema.fields])
