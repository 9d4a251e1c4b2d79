"""Scalar helpers shared by the operators.

Number policy
-------------
* Criteria flags compare exact values: prices stay ``decimal(12,2)``, factors are
  decimal literals, and "x >= f * average" is evaluated by cross-multiplying with
  the exact sum and count (``cross_ge``), so no rounded average decides a flag.
* Ratios and averages that are *shown* are doubles computed by one division of
  exact operands and rounded half away from zero with ``round_half_away``; the same
  IEEE operations give bit-identical values in any engine.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from bursa import constants as K

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dec(x) -> Column:
    """Exact decimal literal (``F.lit(0.97)`` would be a double)."""
    return F.lit(Decimal(str(x)))


def as_double(x: ColumnOrName) -> Column:
    return _c(x).cast("double")


def flag(cond: Column) -> Column:
    """``CASE WHEN cond THEN true ELSE false END``: NULL collapses to false (H-03, H-22)."""
    return F.coalesce(cond, F.lit(False))


def mark(f: ColumnOrName, yes: str = K.MARK_YES, no: str = K.MARK_NO) -> Column:
    """Render a flag as a symbol (H-04); NULL renders as ``no``."""
    return F.when(_c(f), F.lit(yes)).otherwise(F.lit(no))


def score(*flags: ColumnOrName) -> Column:
    """Number of true flags (H-06)."""
    total = F.lit(0)
    for f in flags:
        total = total + F.when(_c(f), 1).otherwise(0)
    return total.cast("int")


def nullif0(x: ColumnOrName) -> Column:
    """``NULLIF(x, 0)`` division guard (H-02)."""
    return F.nullif(_c(x), F.lit(0))


def round_half_away(x: ColumnOrName, scale: int) -> Column:
    """Round a double half away from zero to ``scale`` places (H-07 for doubles)."""
    p = float(10 ** scale)
    x = _c(x).cast("double")
    return F.signum(x) * (F.floor(F.abs(x) * F.lit(p) + F.lit(0.5)) / F.lit(p))


def guarded_ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a / NULLIF(b, 0)`` as a double."""
    return _c(a).cast("double") / F.nullif(_c(b).cast("double"), F.lit(0.0))


def ratio(a: ColumnOrName, b: ColumnOrName, scale: int = 4) -> Column:
    """``ROUND(a / NULLIF(b, 0), scale)`` as a double."""
    return round_half_away(guarded_ratio(a, b), scale)


def pct_change(a: ColumnOrName, b: ColumnOrName, scale: int = 2) -> Column:
    """``ROUND((a - b) / NULLIF(b, 0) * 100, scale)``; always guarded (H-09, Q25)."""
    diff = (_c(a) - _c(b)).cast("double")
    return round_half_away(diff / F.nullif(_c(b).cast("double"), F.lit(0.0)) * F.lit(100.0), scale)


def cross_ge(x: ColumnOrName, f, total: ColumnOrName, count: ColumnOrName) -> Column:
    """Exact ``x >= f * (total / count)`` as ``x * count >= f * total`` (count > 0)."""
    lhs = _c(x).cast("decimal(20,2)") * _c(count).cast("decimal(18,0)")
    return (lhs >= dec(f) * _c(total)) & (_c(count) > 0)


def cross_gt(x: ColumnOrName, f, total: ColumnOrName, count: ColumnOrName) -> Column:
    lhs = _c(x).cast("decimal(20,2)") * _c(count).cast("decimal(18,0)")
    return (lhs > dec(f) * _c(total)) & (_c(count) > 0)


def cross_le(x: ColumnOrName, f, total: ColumnOrName, count: ColumnOrName) -> Column:
    lhs = _c(x).cast("decimal(20,2)") * _c(count).cast("decimal(18,0)")
    return (lhs <= dec(f) * _c(total)) & (_c(count) > 0)


def cross_lt(x: ColumnOrName, f, total: ColumnOrName, count: ColumnOrName) -> Column:
    lhs = _c(x).cast("decimal(20,2)") * _c(count).cast("decimal(18,0)")
    return (lhs < dec(f) * _c(total)) & (_c(count) > 0)


def minute_of_day(ts: ColumnOrName) -> Column:
    """``EXTRACT(HOUR)*60 + EXTRACT(MINUTE)`` (H-17, H-18)."""
    return F.hour(_c(ts)) * 60 + F.minute(_c(ts))


def seconds_between(t1: ColumnOrName, t2: ColumnOrName) -> Column:
    """``EXTRACT(EPOCH FROM t2 - t1)`` with microsecond fractions (H-19)."""
    return F.timestamp_diff("MICROSECOND", _c(t1), _c(t2)) / F.lit(1_000_000.0)


def day_text(d: ColumnOrName) -> Column:
    """``TO_CHAR(d, 'YYYYMMDD')`` (H-14)."""
    return F.date_format(_c(d), "yyyyMMdd")


def text_day(s: ColumnOrName) -> Column:
    """``'YYYYMMDD'::date`` (H-12)."""
    return F.to_date(_c(s), "yyyyMMdd")
