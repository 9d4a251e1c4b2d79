"""DuckDB text of the adapter views (see ``bursa.sources.adapters``).

Used by ``__spark_entry__.oracle_sql`` to build independent oracle queries over the
same raw tables. Each entry is ``name -> (dependencies, select text)``.
"""

from __future__ import annotations

CODE = "'S' || lpad(CAST({x} AS VARCHAR), CAST(greatest(4, length(CAST({x} AS VARCHAR))) AS INTEGER), '0')"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "trades": ((), f"""
SELECT event_id AS trade_no, strftime(ts, '%Y%m%d') AS trade_date, strftime(ts, '%H%M%S') AS trade_time, ts,
       {CODE.format(x='(user_id // 5)')} AS security_code,
       CASE WHEN event_type = 'error' THEN 'NG' ELSE 'RG' END AS board_code,
       CAST(value AS DECIMAL(12,2)) AS price, CAST(100 * (1 + event_id % 50) AS BIGINT) AS volume
FROM events"""),
    "trades_eod": (("trades",), """
SELECT trade_no, CAST(trade_no % 2 + 1 AS INTEGER) AS session, board_code, 'B' || (trade_no % 97) AS seller_broker,
       substr('IASF', CAST(trade_no % 4 + 1 AS INTEGER), 1) AS seller_investor_type,
       'B' || (trade_no * 7 % 89) AS buyer_broker,
       substr('IASF', CAST(trade_no // 4 % 4 + 1 AS INTEGER), 1) AS buyer_investor_type, security_code, volume, price,
       CAST(ts AS DATE) AS trade_date, trade_no * 2 AS seller_order_no, trade_no * 2 + 1 AS buyer_order_no,
       trade_time, ts
FROM trades"""),
    "stock_summary": (("trades",), """
WITH r AS (
  SELECT trade_date AS data_date, trade_time AS data_time, ts, security_code, board_code,
         first_value(price) OVER w AS opening_price, max(price) OVER w AS highest_price,
         min(price) OVER w AS lowest_price, price AS close_price,
         CAST(sum(volume) OVER w AS BIGINT) AS trade_volume,
         CAST(sum(price * volume) OVER w AS BIGINT) AS trade_value,
         count(*) OVER w AS trade_frequency
  FROM trades
  WINDOW w AS (PARTITION BY security_code, trade_date ORDER BY ts, trade_no
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
e AS (SELECT security_code, data_date,
             lag(c) OVER (PARTITION BY security_code ORDER BY data_date) AS previous_price
      FROM (SELECT security_code, trade_date AS data_date, arg_max(price, ts) AS c
            FROM trades GROUP BY 1, 2))
SELECT r.data_date, r.data_time, r.ts, r.security_code, r.board_code, r.opening_price, r.highest_price,
       r.lowest_price, r.close_price, r.trade_volume, r.trade_value, r.trade_frequency, e.previous_price
FROM r JOIN e USING (security_code, data_date)"""),
    "history_ohlc": ((), f"""
SELECT {CODE.format(x='l_suppkey')} AS code, CAST(l_shipdate AS DATE) AS trade_date,
       arg_min(p, (k, p)) AS "open", max(p) AS high, min(p) AS low, arg_max(p, (k, p)) AS "close",
       CAST(sum(v) AS BIGINT) AS volume, CAST(round(sum(p * v)) AS BIGINT) AS "value",
       count(*) AS freq
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS p, CAST(l_quantity AS BIGINT) AS v,
             l_orderkey * 10 + l_linenumber AS k FROM lineitem)
GROUP BY 1, 2"""),
    "daily_ohlc": (("history_ohlc",), """
SELECT CAST(trade_date AS TIMESTAMP) AS bucket, code AS security_code, "open", high, low, "close",
       volume, "value"
FROM history_ohlc"""),
    "orderbook": ((), f"""
SELECT ts, security_code, side,
       CAST(row_number() OVER (PARTITION BY security_code, ts, side
                               ORDER BY CASE WHEN side = 'B' THEN -price ELSE price END, event_id) AS INTEGER) AS level,
       frequency, price, volume
FROM (SELECT date_trunc('hour', ts) AS ts, {CODE.format(x='(user_id // 5)')} AS security_code,
             CASE WHEN event_id % 2 = 0 THEN 'B' ELSE 'O' END AS side,
             CAST(1 + event_id % 7 AS INTEGER) AS frequency, CAST(value AS DECIMAL(12,2)) AS price,
             CAST(100 * (1 + event_id % 50) AS BIGINT) AS volume, event_id
      FROM events)"""),
    "stock_fundamentals": ((), f"""
SELECT {CODE.format(x='s_suppkey')} AS security_code,
       CAST(round(s_acctbal * 1000000) AS BIGINT) AS shares_outstanding,
       DATE '2024-12-31' AS last_updated, s_name AS source
FROM supplier WHERE s_acctbal > 0"""),
    "market_cap": (("history_ohlc", "stock_fundamentals"), """
SELECT m.code, f.source AS listed_stocks, f.shares_outstanding AS number_of_listed_shares,
       CAST((CAST(m.month_close * 100 AS HUGEINT) * f.shares_outstanding + 50000000) // 100000000 AS BIGINT)
           AS market_capitalization,
       CAST(NULL AS DECIMAL(9,4)) AS percentage, CAST(m.month AS INTEGER) AS month, CAST(m.year AS INTEGER) AS year
FROM (SELECT code, year(trade_date) AS year, month(trade_date) AS month,
             arg_max("close", trade_date) AS month_close
      FROM history_ohlc GROUP BY 1, 2, 3) m
JOIN stock_fundamentals f ON m.code = f.security_code"""),
    "free_float": ((), f"""
SELECT {CODE.format(x='s_suppkey')} AS code, CAST(10 + (s_nationkey * 3) % 60 AS DOUBLE) AS free_float_pct
FROM supplier"""),
}


def with_views(*names: str) -> str:
    """``WITH`` clause defining the named views and their dependencies, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in VIEWS[n][0]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]}\n)" for n in order) + "\n"
