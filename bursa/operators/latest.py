"""Latest-row-per-key, day reduction, sorting and top-N (F-01..F-06), source merge (C-03).

``latest_per_key`` is ``row_number() == 1`` over the key. Catalyst turns the rank
filter into a partial ``WindowGroupLimit`` that runs *before* the shuffle, so each
map task ships at most one row per key: a hot key that holds a third of the rows
costs one row per input partition in the exchange, not a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bursa.functions.expr import day_text


def _cols(xs: Sequence[Column | str]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """``DISTINCT ON (keys) ... ORDER BY keys, order``: first row per key under ``order``.

    ``order`` must make rows of one key distinct (append the table key), otherwise
    the pick among ties is arbitrary as it is in the original form.
    """
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def latest_via_partition(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], part_col: str,
                         locate: Column) -> DataFrame:
    """``latest_per_key`` that reads full rows only from the partitions holding a latest row.

    ``locate`` is an aggregate giving, per key, the partition value of its latest row
    (``max(data_date)`` when the order leads with the date, ``max_by(data_date, ts)``
    when it is by ``ts``). A narrow grouped pass finds those values; their distinct set
    (bounded by the calendar) becomes a scalar subquery in the scan's partition filter,
    and a semi-join keeps each key's rows of its own partition before the usual pick.
    The result equals ``latest_per_key(df, keys, order)``.
    """
    last = df.groupBy(*keys).agg(locate.alias("__part"))
    parts = last.select(F.collect_set("__part")).scalar()
    lk = last.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__part")
    cond = [df[k] == lk[f"__k_{k}"] for k in keys] + [df[part_col] == lk["__part"]]
    cand = df.where(F.array_contains(parts, F.col(part_col))).join(lk, cond, "left_semi")
    return latest_per_key(cand, keys, order)


def latest_snapshot(summary: DataFrame, on_date: Column | str | None = None,
                    board: str | None = None) -> DataFrame:
    """Latest intraday snapshot per symbol (F-01), optionally of one ``data_date``.

    ``on_date`` may be a literal ``'yyyyMMdd'`` or a scalar-subquery column; an
    equality on the raw ``data_date`` text reaches the scan as a pushed filter.
    """
    s = summary
    if board is not None:
        s = s.where(F.col("board_code") == board)
    if on_date is not None:
        s = s.where(F.col("data_date") == (F.lit(on_date) if isinstance(on_date, str) else on_date))
        return latest_per_key(s, ["security_code"], [F.col("ts").desc()])
    # over all time: read full rows only from each symbol's last-traded partition
    return latest_via_partition(s, ["security_code"], [F.col("ts").desc()], "data_date",
                                F.max_by("data_date", "ts"))


def eod_snapshots(summary: DataFrame, board: str | None = None, lo: Column | str | None = None,
                  hi: Column | str | None = None, require: Sequence[str] = ()) -> DataFrame:
    """End-of-day row per symbol and date (F-03): the last snapshot of each day.

    ``lo``/``hi`` bound ``data_date`` inclusively as ``yyyyMMdd`` text so the bounds
    prune; ``require`` lists columns that must be non-null (the reference filters).
    """
    s = summary
    if board is not None:
        s = s.where(F.col("board_code") == board)
    for c in require:
        s = s.where(F.col(c).isNotNull())
    if lo is not None:
        s = s.where(F.col("data_date") >= (F.lit(lo) if isinstance(lo, str) else lo))
    if hi is not None:
        s = s.where(F.col("data_date") <= (F.lit(hi) if isinstance(hi, str) else hi))
    return latest_per_key(s, ["security_code", "data_date"], [F.col("ts").desc()])


def nth_last_day(df: DataFrame, col: str, n: int) -> Column:
    """The ``n``-th last distinct day of a table as a scalar subquery (its first, if it has
    fewer): the trading-day index by which a last-n-days screen prunes partitions. The
    set of days is bounded by the calendar."""
    days = F.sort_array(F.collect_set(col), asc=False)
    return df.select(F.element_at(days, F.greatest(F.lit(1), F.least(F.lit(n), F.size(days)))).alias("d")).scalar()


def recent_rows(df: DataFrame, by: str, day: str, n: int, codes: DataFrame, reduce=None) -> DataFrame:
    """The last ``n`` day rows of each of ``codes``, read from the last partitions.

    Rows of the table's last ``n`` trading days hold the last n rows of every code that
    traded on each of them. Codes with gaps, that have fewer rows there, are read from the
    older days too, by a semi-join, so the result is exact for all of ``codes``.
    ``reduce`` makes day rows of a frame (one per code and day); a ``trade_year`` column,
    where the frame has one, prunes year partitions by the same bound.
    """
    reduce = reduce or (lambda x: x)
    wanted = codes.select(by).distinct()
    bound = nth_last_day(df, day, n)
    new, old = df.where(F.col(day) >= bound), df.where(F.col(day) < bound)
    if "trade_year" in df.columns:
        new, old = new.where(F.col("trade_year") >= F.year(bound)), old.where(F.col("trade_year") <= F.year(bound))
    near = reduce(new.join(wanted, by, "left_semi"))
    have = near.groupBy(by).agg(F.count(F.lit(1)).alias("__have"))
    gaps = wanted.join(have, by, "left").where(F.coalesce("__have", F.lit(0)) < n).select(by)
    rows = near.unionByName(reduce(old.join(gaps, by, "left_semi")))
    pos = F.row_number().over(Window.partitionBy(by).orderBy(F.col(day).desc()))
    return rows.withColumn("__pos", pos).where(F.col("__pos") <= n).drop("__pos")


def max_data_date(summary: DataFrame) -> Column:
    """``(SELECT MAX(data_date) FROM stock_summary)`` as a scalar subquery (B-13)."""
    return summary.select(F.max("data_date")).scalar()


def as_of_text(as_of) -> Column:
    """An as-of parameter as ``yyyyMMdd`` text: literal text/date or a date column."""
    import datetime as _dt
    if as_of is None:
        return day_text(F.current_date())
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        return F.lit(as_of.strftime("%Y%m%d"))
    if isinstance(as_of, str):
        return F.lit(as_of.replace("-", ""))
    return as_of


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """``ORDER BY ... LIMIT n`` (F-06) -> ``TakeOrderedAndProject``: each task keeps
    its own top ``n`` and only those rows reach the final merge."""
    return df.orderBy(*_cols(order)).limit(n)


def prefer(primary: DataFrame, fallback: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Full outer join merged per column with ``COALESCE(primary, fallback)`` (C-03)."""
    p = primary.select(key, *[F.col(c).alias(f"__p_{c}") for c in cols])
    f = fallback.select(key, *[F.col(c).alias(f"__f_{c}") for c in cols])
    j = p.join(f, key, "full_outer")
    return j.select(key, *[F.coalesce(f"__p_{c}", f"__f_{c}").alias(c) for c in cols])


def exact_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order)`` without one task per group.

    A window puts every row of a group into one task. Here the rows are range-sorted by
    ``(keys, order)`` — the range boundaries split even a single huge group across many
    tasks — and written once, with their place, to the shared checkpoint folder. All
    later steps read that one copy: a row's position is its part's offset (prefix sum of
    one count per part) plus its index inside the part, and its rank is the position less
    its group's first position. The group positions are stored too, so the last join has
    plain shuffles on both sides and a hot group's rows can be split.
    ``order`` must be total within a group for a deterministic result.
    """
    from pyspark.sql import Window

    from bursa.session import cut_lineage
    srt = df.orderBy(*[F.col(k) for k in keys], *_cols(order))
    t = cut_lineage(srt.withColumns({"__pid": F.spark_partition_id(), "__mid": F.monotonically_increasing_id()}))
    t = t.withColumn("__local", F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33))
    counts = t.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__pid", (F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"))
    pos = t.join(offsets, "__pid").withColumn("__pos", F.coalesce("__off", F.lit(0)) + F.col("__local"))
    first = cut_lineage(pos.groupBy(*keys).agg(F.min("__pos").alias("__first")))
    out = pos.join(first, list(keys)).withColumn(name, (F.col("__pos") - F.col("__first") + 1).cast("int"))
    return out.drop("__pid", "__mid", "__local", "__off", "__pos", "__first")
