"""Candle metrics and criteria flags (S-07..S-13, S-21..S-26).

Every flag is NULL-safe (``CASE WHEN ... THEN true ELSE false``) and exact: prices
are decimals, factors are decimal literals, and comparisons against averages are
cross-multiplied with the exact sum and day count. Thresholds are keyword
parameters whose defaults are the reference's constants.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bursa import constants as K

from bursa.functions.expr import (cross_ge, cross_lt, dec, flag, ratio, round_half_away,
                                  guarded_ratio)


def _c(x):
    return F.col(x) if isinstance(x, str) else x


# --- metrics (S-07) -------------------------------------------------------------------

def candle_range(high="highest_price", low="lowest_price") -> Column:
    return _c(high) - _c(low)


def lower_shadow(close="current_price", low="lowest_price") -> Column:
    return _c(close) - _c(low)


def lower_shadow_ratio(close="current_price", low="lowest_price", high="highest_price") -> Column:
    """``CASE WHEN range > 0 THEN ROUND(shadow / range, 4) ELSE 0 END``."""
    rng = candle_range(high, low)
    return F.when(rng > 0, ratio(lower_shadow(close, low), rng, 4)).otherwise(F.lit(0.0))


def price_to_open_ratio(close="current_price", open_="opening_price") -> Column:
    return ratio(close, open_, 4)


# --- original five criteria -------------------------------------------------------------

def down_from_open(close="current_price", open_="opening_price", f=K.DOWN_FROM_OPEN) -> Column:
    """Criterion 1: close <= f * open (S-08)."""
    return flag(_c(close) <= dec(f) * _c(open_))


def long_lower_shadow(close="current_price", low="lowest_price", high="highest_price",
                      f=K.LOWER_SHADOW) -> Column:
    """Criterion 2: close - low >= f * (high - low) and close > low (S-09)."""
    return flag((lower_shadow(close, low) >= dec(f) * candle_range(high, low)) & (_c(close) > _c(low)))


def volume_surge(volume="trade_volume", vol_sum="vol_sum", vol_days="vol_days", f=K.VOLUME_SURGE) -> Column:
    """Criterion 3: volume >= f * average volume (S-10)."""
    return flag(_c(vol_sum).isNotNull() & cross_ge(volume, f, vol_sum, vol_days))


def volume_below_avg(volume="trade_volume", vol_sum="vol_sum", vol_days="vol_days") -> Column:
    """Criterion 3b: volume < average volume (S-11)."""
    return flag(_c(vol_sum).isNotNull() & cross_lt(volume, 1, vol_sum, vol_days))


def liquid(value="trade_value", min_value=K.LIQUID_VALUE) -> Column:
    """Criterion 4: traded value >= min_value (S-12)."""
    return flag(_c(value) >= F.lit(int(min_value)))


def near_support(low="lowest_price", previous_low="previous_low", f=K.NEAR_SUPPORT) -> Column:
    """Criterion 5: low <= f * previous low (S-13)."""
    return flag(_c(previous_low).isNotNull() & (_c(low) <= dec(f) * _c(previous_low)))


# --- trade-tape and trend criteria ----------------------------------------------------------

def trade_flow_momentum(momentum_pct="tape_momentum_pct", min_pct=K.TAPE_MOMENTUM_PCT) -> Column:
    """Criterion 6: intraday (max - min) / min >= min_pct percent (S-21)."""
    return flag(_c(momentum_pct) >= F.lit(float(min_pct)))


def aggressive_buying(up_volume="tape_up_volume", total_volume="tape_total_volume", f=K.AGGRESSIVE_BUY_SHARE) -> Column:
    """Criterion 7: up-tick volume / total volume >= f (S-22)."""
    return flag((_c(total_volume) > 0) & (_c(up_volume) >= dec(f) * _c(total_volume)))


def not_overheated(volume="trade_volume", vol_sum="vol_sum", vol_days="vol_days", f=K.NOT_OVERHEATED) -> Column:
    """Criterion 8: volume < f * average volume (S-23)."""
    return flag(_c(vol_sum).isNotNull() & cross_lt(volume, f, vol_sum, vol_days))


def price_strengthening(close="current_price", previous="previous_price", f=K.STRENGTHENING) -> Column:
    """Criterion 9: close > f * previous close (S-24)."""
    return flag(_c(previous).isNotNull() & (_c(close) > _c(previous) * dec(f)))


def not_overextended(close="current_price", min_close="min_price_20d", f=K.NOT_OVEREXTENDED) -> Column:
    """Criterion 11: close <= f * lowest close of the range window (S-25)."""
    return flag(_c(min_close).isNotNull() & (_c(close) <= _c(min_close) * dec(f)))


def not_in_downtrend(close="current_price", max_close="max_price_20d", f=K.NOT_IN_DOWNTREND) -> Column:
    """Criterion 12: close >= f * highest close of the range window (S-26)."""
    return flag(_c(max_close).isNotNull() & (_c(close) >= _c(max_close) * dec(f)))


def avg_double(total="vol_sum", count="vol_days") -> Column:
    """Average shown as a double: one division of the exact sum."""
    return guarded_ratio(total, count)


def avg_rounded(total="vol_sum", count="vol_days", scale=0) -> Column:
    return round_half_away(avg_double(total, count), scale)
