"""Rolling statistics per symbol (E-01..E-14).

All windows partition by the symbol and order by the day, so at day grain a
partition holds one row per trading day of one symbol (bounded by the calendar,
not by the data volume). Frame sums and counts are kept exact; moving averages are
derived from them so comparisons can cross-multiply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def rows_window(by: str, order: str, n: int, end: int = 0) -> WindowSpec:
    """``ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW`` (``end`` shifts the frame back)."""
    return Window.partitionBy(by).orderBy(order).rowsBetween(-(n - 1) + end, end)


def last_rows(df: DataFrame, by: str, order: str, n: int) -> DataFrame:
    """Each group's last ``n`` rows: a limit inside each task before the shuffle, so the
    windows of a last-day screen don't run over the whole history."""
    pos = F.row_number().over(Window.partitionBy(by).orderBy(F.col(order).desc()))
    return df.withColumn("__pos", pos).where(F.col("__pos") <= n).drop("__pos")


def with_moving_sums(df: DataFrame, specs: dict[str, tuple[str, int, str]], by: str, order: str) -> DataFrame:
    """Exact moving sums and counts over the last ``n`` rows, O(1) per row.

    ``specs`` maps an output prefix to ``(column, n, decimal type)`` and produces
    ``{prefix}_sum`` and ``{prefix}_n``. A sliding ROWS frame is re-aggregated over the
    whole frame for every row (O(n) per row); here the moving sum is the running
    (prefix) sum minus the prefix sum ``n`` rows back, which is exact for decimals.
    The sum is NULL when the frame has no non-null value, as ``SUM`` is.
    """
    w = Window.partitionBy(by).orderBy(order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = {}
    for name, (col, _n, dtype) in specs.items():
        cols[f"__{name}_cs"] = F.sum(F.col(col).cast(dtype)).over(run)
        cols[f"__{name}_cc"] = F.count(col).over(run)
    out = df.withColumns(cols)
    res, drop = {}, []
    for name, (_col, n, _dtype) in specs.items():
        cs, cc = F.col(f"__{name}_cs"), F.col(f"__{name}_cc")
        cnt = cc - F.coalesce(F.lag(cc, n).over(w), F.lit(0))
        total = cs - F.coalesce(F.lag(cs, n).over(w), F.lit(0))
        res[f"{name}_n"] = cnt
        res[f"{name}_sum"] = F.when(cnt > 0, total)
        drop += [f"__{name}_cs", f"__{name}_cc"]
    return out.withColumns(res).drop(*drop)


def lag(col: str | Column, by: str | list[str], order, k: int = 1) -> Column:
    """``LAG(col, k) OVER (PARTITION BY by ORDER BY order)`` (E-05, E-06)."""
    by = [by] if isinstance(by, str) else by
    order = [order] if isinstance(order, (str, Column)) else order
    return F.lag(_c(col), k).over(Window.partitionBy(*by).orderBy(*order))


def with_rsi(df: DataFrame, close: str, by: str, order: str, n: int = 14,
             name: str = "rsi") -> DataFrame:
    """Simple-average RSI(n) (E-14): ``100 - 100 / (1 + avg_gain / avg_loss)`` over the
    last ``n`` close-to-close changes; 100 when there is no loss; NULL until ``n``
    changes exist. Gains and losses are exact decimals; the ratio is a double."""
    chg = f"__{name}_chg"
    out = df.withColumn(chg, _c(close) - F.lag(_c(close)).over(Window.partitionBy(by).orderBy(order)))
    w = rows_window(by, order, n)
    gain = F.sum(F.when(F.col(chg) > 0, F.col(chg)).otherwise(F.lit(0))).over(w)
    loss = F.sum(F.when(F.col(chg) < 0, -F.col(chg)).otherwise(F.lit(0))).over(w)
    n_changes = F.count(F.col(chg)).over(w)
    value = F.when(loss == 0, F.lit(100.0)).otherwise(
        F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + gain.cast("double") / loss.cast("double")))
    return out.withColumn(name, F.when(n_changes >= n, value)).drop(chg)


def with_wilder_rsi(df: DataFrame, close: str = "close", by: str = "code", order: str = "trade_date",
                    n: int = 14, name: str = "rsi_wilder") -> DataFrame:
    """Wilder-smoothed RSI(n) (E-14, the recursive option).

    The first average is the mean of the first ``n`` gains/losses (exact decimal sum
    / n); after that ``avg = (avg * (n - 1) + x) / n``. The recursion has no window form:
    each symbol's bars are gathered, sorted, and folded by the built-in ``aggregate``, so
    no row leaves the JVM. One array is one symbol's calendar of bars, the same unit a
    day-grain window partition holds. NULL until ``n`` changes exist; 100 when the average
    loss is 0. ``order`` must be unique within a symbol and ``close`` not null.
    """
    rest = [c for c in df.columns if c not in (order, close)]
    bars = df.groupBy(F.col(by).alias("__by")).agg(F.array_sort(F.collect_list(
        F.struct(F.col(order), F.col(close).cast("decimal(30,2)").alias("__close"), F.col(close),
                 F.struct(*rest).alias("__rest")))).alias("__bars"))
    # changes between neighbours, then (gain, loss) of each
    bars = bars.withColumn("__moves", F.expr("""
        transform(slice(__bars, 2, greatest(size(__bars) - 1, 0)), (b, i) -> b.__close - __bars[i].__close)"""))
    bars = bars.withColumn("__moves", F.expr("""
        transform(__moves, m -> struct(greatest(m, 0) AS gain, greatest(-m, 0) AS loss))"""))

    def first(part: str) -> str:  # exact sum of the first n, then one division
        return (f"CAST(aggregate(slice(__moves, 1, {n}), CAST(0 AS DECIMAL(38,2)), "
                f"(a, m) -> CAST(a + m.{part} AS DECIMAL(38,2))) AS DOUBLE) / {n}D")

    def smoothed(part: str) -> str:
        return f"(s.{part} * {n - 1}D + CAST(m.{part} AS DOUBLE)) / {n}D"

    state = "struct<gain: double, loss: double, out: array<struct<gain: double, loss: double>>>"
    fold = f"""
        aggregate(slice(__moves, {n + 1}, greatest(size(__moves) - {n}, 0)),
                  CAST(named_struct('gain', __g, 'loss', __l, 'out', array(named_struct('gain', __g, 'loss', __l)))
                       AS {state}),
                  (s, m) -> CAST(named_struct('gain', {smoothed("gain")}, 'loss', {smoothed("loss")}, 'out',
                      concat(s.out, array(named_struct('gain', {smoothed("gain")}, 'loss', {smoothed("loss")}))))
                      AS {state}),
                  s -> s.out)"""
    bars = bars.withColumns({"__g": F.expr(first("gain")), "__l": F.expr(first("loss"))})
    bars = bars.withColumn("__avg", F.expr(f"CASE WHEN size(__moves) >= {n} THEN {fold} END"))
    rows = bars.select(F.posexplode("__bars").alias("__i", "__bar"), "__avg")
    avg = F.try_element_at("__avg", F.when(F.col("__i") >= n, F.col("__i") - n + 1))
    value = F.when(avg["loss"] == 0, F.lit(100.0)).otherwise(
        F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + avg["gain"] / avg["loss"]))
    back = {c: F.col(f"__bar.__rest.{c}") for c in rest} | {order: F.col(f"__bar.{order}"), close: F.col(f"__bar.{close}")}
    return rows.select(*[back[c].alias(c) for c in df.columns],
                       F.when((F.col("__i") >= n) & avg.isNotNull(), value).alias(name))


def with_extremes(df: DataFrame, specs: dict[str, tuple[str, str, int]], by: str, order: str) -> DataFrame:
    """Highest / lowest of the last ``n`` rows (E-12) in log2(n) steps a row instead of n.

    ``specs`` maps an output name to ``(column, "max" or "min", n)``. The extreme of 2k
    rows is that of the last k rows and of the k rows before them, read by ``LAG``, so
    each doubling serves every longer frame of the column, and a frame of n rows is two
    overlapping ones of the largest power of two below n. All steps share one exchange
    and one sort; a sliding frame would compare n values for every row. NULLs are skipped
    and frames at a symbol's start are as short as its rows, as in a ROWS frame.
    """
    w = Window.partitionBy(by).orderBy(order)
    pick = {"max": F.greatest, "min": F.least}
    lines: dict[tuple[str, str], list[str]] = {}
    for col, kind, n in specs.values():
        lines.setdefault((col, kind), [col])
    reach, names = 1, []
    longest = max(n for _, _, n in specs.values())
    out = df
    while reach * 2 <= longest:
        step = {}
        for (col, kind), levels in lines.items():
            if reach * 2 <= max(n for c, k, n in specs.values() if (c, k) == (col, kind)):
                levels.append(f"__{kind}_{col}_{reach * 2}")
                step[levels[-1]] = pick[kind](F.col(levels[-2]), F.lag(levels[-2], reach).over(w))
        names += step
        out, reach = out.withColumns(step), reach * 2
    last = {}
    for name, (col, kind, n) in specs.items():
        level = n.bit_length() - 1
        top, shift = lines[col, kind][level], n - (1 << level)
        last[name] = pick[kind](F.col(top), F.lag(top, shift).over(w)) if shift else F.col(top)
    return out.withColumns(last).drop(*names)
