"""As-of join: each left row with the last right row at or before its time.

Spark has no such join, and an inequality join pairs every left row with all earlier
right rows. Here both sides are laid on one time line per key and the last right row is
carried forward by a window, so the cost is one exchange and one sort whatever the
number of earlier rows. With ``slice_of`` the time line of a key is cut into slices that
are windows of their own; a slice's first rows take the last right row of the slices
before it, found in a frame of one row per key and slice, so a key that holds most rows
is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: Column | str, right_time: Column | str,
              cols: Sequence[str], *, strict: bool = False,
              slice_of: Callable[[Column], Column] | None = None) -> DataFrame:
    """``left`` with ``cols`` of the last right row of the same ``by`` at or before its time
    (``strict``: before it); NULL where there is none.

    Both times must have one type. Right rows with a null key or time match nothing, left
    ones keep NULL. Of several right rows at one time the largest by ``cols`` counts, so
    the result never depends on the row order. ``slice_of`` maps a time to its slice,
    which must not decrease as time grows (e.g. the month).
    """
    def col(x: Column | str) -> Column:
        return F.col(x) if isinstance(x, str) else x

    by, taken = list(by), F.struct(*cols)
    late = 2 if strict else 0  # at one time, right rows come first unless the join is strict
    line = left.withColumns({"__time": col(left_time), "__side": F.lit(1), "__row": F.lit(None)})
    there = right.where(col(right_time).isNotNull())
    for c in by:
        there = there.where(F.col(c).isNotNull())
    there = there.select(*by, col(right_time).alias("__time"), F.lit(late).alias("__side"), taken.alias("__row"))
    line = line.withColumn("__row", F.col("__row").cast(there.schema["__row"].dataType)) \
        .unionByName(there, allowMissingColumns=True)
    keys = list(by)
    if slice_of is not None:
        line, keys = line.withColumn("__slice", slice_of(F.col("__time"))), [*by, "__slice"]
    w = Window.partitionBy(*keys).orderBy("__time", "__side", "__row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = line.withColumn("__last", F.last("__row", ignorenulls=True).over(w))
    if slice_of is not None:
        order = F.struct("__time", "__row")
        ends = line.groupBy(*keys).agg(F.max_by("__row", F.when(F.col("__row").isNotNull(), order)).alias("__end"))
        before = Window.partitionBy(*by).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
        carry = ends.select(*[F.col(c).alias(f"__{c}_k") for c in keys],
                            F.last("__end", ignorenulls=True).over(before).alias("__carry"))
        same = [F.col(c).eqNullSafe(F.col(f"__{c}_k")) for c in keys]
        out = out.where(F.col("__side") == 1).join(carry, same, "left") \
            .withColumn("__last", F.coalesce("__last", "__carry"))
    known = F.col("__time").isNotNull()
    for c in by:
        known = known & F.col(c).isNotNull()
    return out.where(F.col("__side") == 1).select(
        *[F.col(c) for c in left.columns], *[F.when(known, F.col(f"__last.{c}")).alias(c) for c in cols])
