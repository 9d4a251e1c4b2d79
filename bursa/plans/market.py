"""Market lists from the feed specification: top gainers / losers (S-42), most
active (S-43) and order-book totals (S-44).

Rankings are ``ORDER BY ... LIMIT n`` (``TakeOrderedAndProject``: each task keeps
its own top ``n``); the rank column is numbered over the ``n`` survivors only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bursa import constants as K

from bursa.functions.expr import guarded_ratio, pct_change
from bursa.operators.latest import latest_snapshot, max_data_date


def _ranked(df: DataFrame, order, n: int, kind: str) -> DataFrame:
    top = df.orderBy(*order).limit(n)
    return top.select(F.lit(kind).alias("kind"),
                      F.row_number().over(Window.orderBy(*order)).alias("rank"), *df.columns)


def top_movers(summary: DataFrame, n: int = K.TOP_LIST_SIZE, direction: str = "gainer") -> DataFrame:
    """S-42: ``n`` symbols with the largest (``gainer``) or smallest (``loser``) percent
    change of the latest snapshot against the previous price, on the latest date."""
    ls = latest_snapshot(summary, max_data_date(summary)).where(F.col("previous_price") > 0)
    chg = guarded_ratio(F.col("close_price") - F.col("previous_price"), "previous_price")
    base = ls.select("security_code", "close_price", "previous_price", chg.alias("__chg"),
                     pct_change("close_price", "previous_price").alias("pct_change"))
    if direction == "gainer":
        order = [F.col("__chg").desc(), F.col("security_code")]
    elif direction == "loser":
        order = [F.col("__chg").asc(), F.col("security_code")]
    else:
        raise ValueError("direction is 'gainer' or 'loser'")
    return _ranked(base, order, n, f"top_{direction}").drop("__chg")


def most_active(summary: DataFrame, n: int = K.TOP_LIST_SIZE, by: str = "trade_value") -> DataFrame:
    """S-43: ``n`` most active symbols of the latest date by value, volume or frequency."""
    if by not in ("trade_value", "trade_volume", "trade_frequency"):
        raise ValueError("by is trade_value, trade_volume or trade_frequency")
    ls = latest_snapshot(summary, max_data_date(summary)).select(
        "security_code", "trade_value", "trade_volume", "trade_frequency")
    return _ranked(ls, [F.col(by).desc(), F.col("security_code")], n, "most_active")


def book_totals(orderbook: DataFrame) -> DataFrame:
    """S-44: total bid/offer queue and volume of each symbol's latest book per side.

    The latest ``ts`` per (symbol, side) is a small aggregate semi-joined back, so
    no window buffers a symbol's whole book history.
    """
    last = orderbook.groupBy("security_code", "side").agg(F.max("ts").alias("ts"))
    cur = orderbook.join(last, ["security_code", "side", "ts"], "left_semi")
    bid, off = F.col("side") == "B", F.col("side") == "O"
    return cur.groupBy("security_code").agg(
        F.sum(F.when(bid, F.col("frequency")).otherwise(0)).cast("bigint").alias("total_bid_queue"),
        F.sum(F.when(bid, F.col("volume")).otherwise(0)).cast("bigint").alias("total_bid_volume"),
        F.sum(F.when(off, F.col("frequency")).otherwise(0)).cast("bigint").alias("total_offer_queue"),
        F.sum(F.when(off, F.col("volume")).otherwise(0)).cast("bigint").alias("total_offer_volume"),
    )
