"""Time slices of a symbol-day, cut finer where trades come in a burst.

Windows over (symbol, day) put a hot symbol-day into one task. Operators on the tape
work in two levels instead: windows inside slices of a few minutes, and one row per
slice carried over to the next. A burst -- a slice that holds more than ``hot_rows`` --
is cut further at quantiles of its own (time, trade number), taken from a sketch that
Spark merges over all tasks, so any share of the table in one minute, or at one instant,
is spread over many window partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 200_000
CUTS = 256


def _place(ts: str, tie: str, minutes: int) -> Column:
    """A number that grows with (ts, tie) inside a slice, exact in a double."""
    length = minutes * 60_000_000
    micros = F.timestamp_diff("MICROSECOND", F.date_trunc("day", ts), F.col(ts)) % length
    places = (1 << (52 - length.bit_length())) - 1  # of trades at one instant; all stay below 2^53
    share = (F.col(tie) - F.col("__lo")).cast("double") / F.greatest(F.col("__hi") - F.col("__lo"), F.lit(1)).cast("double")
    return micros * F.lit(places + 1) + F.floor(share * F.lit(places))


def with_slices(df: DataFrame, keys: list[str], ts: str = "ts", tie: str = "trade_no", minutes: int = 5,
                hot_rows: int = HOT_ROWS, cuts: int = CUTS) -> tuple[DataFrame, list[str]]:
    """``df`` with its slice columns, and their names: they grow with (ts, tie) within ``keys``.

    A narrow grouped pass counts the slices first; only if one is hot are borders made
    and joined, else the plan is that of fixed slices."""
    slice_of = F.floor((F.hour(ts) * 60 + F.minute(ts)) / F.lit(minutes)).cast("int")
    d, k = df.withColumn("__slice", slice_of), [*keys, "__slice"]
    sizes = d.groupBy(*k).agg(F.count(F.lit(1)).alias("__rows"), F.min(tie).alias("__lo"), F.max(tie).alias("__hi")) \
        .where(F.col("__rows") > hot_rows).drop("__rows")
    if sizes.isEmpty():
        return d, ["__slice"]
    at = [i / cuts for i in range(1, cuts)]
    borders = d.select(*k, ts, tie).join(sizes, k).withColumn("__place", _place(ts, tie, minutes)) \
        .groupBy(*k, "__lo", "__hi").agg(F.percentile_approx("__place", at, 20 * cuts).alias("__borders"))
    place = _place(ts, tie, minutes)
    sub = F.size(F.filter(F.array_distinct("__borders"), lambda b: b < F.col("__place")))
    cut = d.join(borders, k, "left").withColumn("__place", place) \
        .withColumn("__sub", F.when(F.col("__borders").isNull(), 0).otherwise(sub)) \
        .drop("__lo", "__hi", "__borders", "__place")
    # by all keys, so that the parts of a burst go to tasks of their own
    return cut.repartition(*[F.col(c) for c in (*k, "__sub")]), ["__slice", "__sub"]
