"""Micro-fixtures: small hand-checkable market rows (summary, trades)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from bursa.sources.schemas import STOCK_SUMMARY, TRADES


# Invented snapshots of one afternoon (ts runs 7 h ahead of data_time); VIZO has two.
def _snap(time, code, prices, volume, freq, previous):
    o, h, lo, c = (D(f"{p}.00") for p in prices)
    at = dt.datetime.strptime(f"20240115{time}", "%Y%m%d%H%M%S") + dt.timedelta(hours=7)
    return "20240115", time, at, code, "RG", o, h, lo, c, volume, volume * int(c), freq, D(f"{previous}.00")


SUMMARY_ROWS = [
    _snap("150100", "KAVO", (200, 212, 198, 205), 120_000, 40, 201),
    _snap("150200", "LUMA", (505, 520, 500, 515), 64_000, 31, 510),
    _snap("150300", "PIRA", (75, 78, 75, 77), 9_000, 12, 76),
    _snap("150400", "VIZO", (1_000, 1_040, 990, 1_010), 33_000, 18, 995),
    _snap("150600", "VIZO", (1_000, 1_040, 990, 1_025), 35_500, 21, 995),
    _snap("150500", "ZELT", (60, 60, 58, 59), 700, 3, 60),
]

TRADE_ROWS = [
    (500 + k, "20240115", time, dt.datetime.strptime(f"20240115{time}", "%Y%m%d%H%M%S") + dt.timedelta(hours=7),
     code, "RG", D(f"{price}.00"), volume)
    for k, (time, code, price, volume) in enumerate([
        ("100000", "KAVO", 210, 500), ("100000", "KAVO", 210, 800), ("100500", "KAVO", 210, 300),
        ("101500", "KAVO", 205, 900), ("110000", "LUMA", 515, 100), ("110000", "LUMA", 515, 250),
        ("140000", "PIRA", 77, 1_000)])
]


def summary_df(spark, rows=None):
    return spark.createDataFrame(rows or SUMMARY_ROWS, STOCK_SUMMARY)


def trades_df(spark, rows=None):
    return spark.createDataFrame(rows or TRADE_ROWS, TRADES)
