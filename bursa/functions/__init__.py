"""Column-expression helpers (scalar functions H-01..H-22). All are JVM-side built-ins."""

from bursa.functions.expr import (  # noqa: F401
    dec, flag, mark, score, nullif0, round_half_away, ratio, pct_change, minute_of_day,
    seconds_between, day_text, text_day, cross_ge, cross_gt, cross_le, cross_lt,
    guarded_ratio, as_double,
)
