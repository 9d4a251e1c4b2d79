"""Intraday session buckets (S-28).

The afternoon trend takes the largest day-cumulative volume seen in three
minute-of-day buckets ([870, 900], [900, 930], >= 930; adjacent buckets share their
boundary minute, Q23) and flags a strictly rising sequence. One grouped pass with
conditional maxima (D-09, D-18).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bursa import constants as K

from bursa.functions.expr import flag, minute_of_day


def afternoon_volume_trend(summary: DataFrame, on_date: Column, *, clock: str = "ts",
                           start: int = K.AFTERNOON_START, mid: int = K.AFTERNOON_MID,
                           late: int = K.AFTERNOON_LATE) -> DataFrame:
    m = minute_of_day(clock)
    s = summary.where((F.col("data_date") == on_date) & (m >= start))
    v1 = F.max(F.when(m.between(start, mid), F.col("trade_volume")))
    v2 = F.max(F.when(m.between(mid, late), F.col("trade_volume")))
    v3 = F.max(F.when(m >= late, F.col("trade_volume")))
    return (s.groupBy("security_code")
             .agg(v1.alias("volume_1430_1500"), v2.alias("volume_1500_1530"), v3.alias("volume_1530_close"))
             .withColumn("is_volume_increasing",
                         flag((F.col("volume_1530_close") > F.col("volume_1500_1530"))
                              & (F.col("volume_1500_1530") > F.col("volume_1430_1500")))))
