"""DuckDB SQL for the correctness oracle.

``tape.sources.fixtures`` defines the tick views in Spark; the constants here
define the same views in DuckDB SQL so every registered query can be checked
against an independent engine on the raw test tables.  Literals are written
as doubles (``CAST(x AS DOUBLE)``) so both engines do the same float math.
"""

from __future__ import annotations

from tape.schemas import BOOK_LEVELS, EXCHANGES, TRADE_CONDITIONS


def _list(values):
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


EV = """ev AS (
  SELECT event_type || '_' || CAST(user_id % 5 AS VARCHAR) AS symbol,
         ts AS "timestamp", event_id AS tick_id, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)"""

TRADES = f"""trades AS (
  SELECT symbol, "timestamp", value AS trade_price, k AS trade_size,
         {_list(EXCHANGES)}[tick_id % 6 + 1] AS exchange,
         {_list(TRADE_CONDITIONS)}[tick_id % 5 + 1] AS trade_condition,
         CASE WHEN k = 0 THEN 'MISSING_FIELD' WHEN value > 250 THEN 'PRICE_OUTLIER' ELSE 'OK' END
           AS data_quality_flag,
         tick_id
  FROM ev)"""

QUOTES = f"""q0 AS (
  SELECT *, tick_id % 1000 = 7 AS crossed,
         CAST(100 AS DOUBLE) + value / CAST(10 AS DOUBLE) AS mid0,
         (k + 1) / CAST(1000 AS DOUBLE) AS half,
         100 * ((7 * tick_id) % 97) AS bsz
  FROM ev),
quotes AS (
  SELECT symbol, "timestamp",
         CASE WHEN crossed THEN mid0 + half ELSE mid0 - half END AS bid_price,
         CASE WHEN crossed THEN mid0 - half ELSE mid0 + half END AS ask_price,
         bsz AS bid_size, 100 * (1 + tick_id % 5) AS ask_size,
         {_list(EXCHANGES)}[tick_id % 6 + 1] AS exchange,
         CASE WHEN crossed THEN 'CROSSED_SPREAD' WHEN tick_id % 500 = 3 THEN 'STALE'
              WHEN bsz = 0 THEN 'MISSING_FIELD' ELSE 'OK' END AS data_quality_flag,
         tick_id
  FROM q0)"""

BOOK_RAW = f"""b0 AS (
  SELECT *, tick_id % 700 = 5 AS crossed,
         tick_id % 400 = 11 AND NOT (tick_id % 700 = 5) AS missing,
         CAST(100 AS DOUBLE) + value / CAST(10 AS DOUBLE) AS mid0,
         (k + 1) / CAST(1000 AS DOUBLE) AS half
  FROM ev),
b1 AS (
  SELECT *,
         CASE WHEN crossed THEN mid0 + half + CAST(0.01 AS DOUBLE) ELSE mid0 - half END AS bid1,
         CASE WHEN crossed THEN mid0 - half - CAST(0.01 AS DOUBLE) ELSE mid0 + half END AS ask1
  FROM b0),
book_raw AS (
  SELECT symbol, "timestamp",
    list_transform(range(1, {BOOK_LEVELS + 1}), lambda i: CASE WHEN missing AND i > 5 THEN CAST(0 AS DOUBLE)
        ELSE bid1 - (i - 1) * CAST(0.02 AS DOUBLE) END) AS bid_prices,
    list_transform(range(1, {BOOK_LEVELS + 1}), lambda i: CASE WHEN missing AND i > 5 THEN CAST(0 AS BIGINT)
        ELSE 100 * (1 + (tick_id * i) % 7) END) AS bid_sizes,
    list_transform(range(1, {BOOK_LEVELS + 1}), lambda i: CASE WHEN missing AND i > 5 THEN CAST(0 AS DOUBLE)
        ELSE ask1 + (i - 1) * CAST(0.02 AS DOUBLE) END) AS ask_prices,
    list_transform(range(1, {BOOK_LEVELS + 1}), lambda i: CASE WHEN missing AND i > 5 THEN CAST(0 AS BIGINT)
        ELSE 100 * (1 + (tick_id * i) % 5) END) AS ask_sizes,
    CASE WHEN crossed THEN 'CROSSED_BOOK' WHEN missing THEN 'MISSING_LEVELS' ELSE 'OK' END AS data_quality_flag,
    tick_id
  FROM b1)"""

def half_up(x: str, digits: int) -> str:
    """``x`` rounded by way of a decimal with six places more."""
    return f"CAST(round(CAST({x} AS DECIMAL(38, {digits + 6})), {digits}) AS DOUBLE)"


# C6–C8 in DuckDB list functions (dot products by level index).
BOOK = f"""bk0 AS (
  SELECT *,
    (bid_prices[1] + ask_prices[1]) / CAST(2 AS DOUBLE) AS m_raw,
    list_sum(list_transform(range(1, len(bid_prices) + 1), lambda i: bid_prices[i] * bid_sizes[i]))
      + list_sum(list_transform(range(1, len(ask_prices) + 1), lambda i: ask_prices[i] * ask_sizes[i])) AS num,
    CAST(list_sum(bid_sizes) AS BIGINT) AS sb, CAST(list_sum(ask_sizes) AS BIGINT) AS sa
  FROM book_raw),
order_book_snapshots AS (
  SELECT symbol, "timestamp", bid_prices, bid_sizes, ask_prices, ask_sizes,
    {half_up('m_raw', 4)} AS mid_price,
    coalesce(CASE WHEN sb + sa = 0 THEN NULL ELSE {half_up('num / (sb + sa)', 4)} END, {half_up('m_raw', 4)}) AS weighted_mid,
    coalesce(CASE WHEN sb + sa = 0 THEN NULL
             ELSE {half_up('CAST(sb - sa AS DOUBLE) / CAST(sb + sa AS DOUBLE)', 4)} END, CAST(0 AS DOUBLE)) AS book_imbalance,
    data_quality_flag, tick_id
  FROM bk0)"""

STG_TRADES = """stg_trades AS (
  SELECT symbol, "timestamp", CAST("timestamp" AS DATE) AS trade_date, trade_price, trade_size,
         trade_price * trade_size AS trade_notional, exchange, trade_condition, data_quality_flag,
         data_quality_flag <> 'OK' AS has_quality_issue, tick_id
  FROM trades WHERE trade_price > 0)"""

STG_QUOTES = """stg_quotes AS (
  SELECT symbol, "timestamp", CAST("timestamp" AS DATE) AS quote_date, bid_price, ask_price, bid_size, ask_size,
         ask_price - bid_price AS spread,
         CASE WHEN bid_price > 0
              THEN (ask_price - bid_price) / ((bid_price + ask_price) / CAST(2 AS DOUBLE)) * CAST(10000 AS DOUBLE)
         END AS spread_bps,
         (bid_price + ask_price) / CAST(2 AS DOUBLE) AS mid_price,
         exchange, data_quality_flag, data_quality_flag <> 'OK' AS has_quality_issue, tick_id
  FROM quotes WHERE bid_price > 0 AND ask_price > 0)"""

LI_TRADES = f"""trades AS (
  SELECT 'S' || lpad(CAST(l_suppkey % 25 AS VARCHAR), 2, '0') AS symbol,
         l_shipdate + INTERVAL 14 HOUR + INTERVAL 30 MINUTE
           + to_seconds((17 * l_orderkey + 31 * l_partkey + 7 * l_linenumber) % 23400) AS "timestamp",
         l_extendedprice / l_quantity AS trade_price,
         CAST(l_quantity AS BIGINT) AS trade_size,
         {_list(EXCHANGES)}[l_orderkey % 6 + 1] AS exchange,
         {_list(TRADE_CONDITIONS)}[l_linenumber % 5 + 1] AS trade_condition,
         'OK' AS data_quality_flag,
         l_orderkey, l_partkey, l_suppkey, l_linenumber
  FROM lineitem)"""

STG_LI_TRADES = STG_TRADES.replace("tick_id", "l_orderkey, l_partkey, l_suppkey, l_linenumber")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


TRADE_CTES = (EV, TRADES, STG_TRADES)
QUOTE_CTES = (EV, QUOTES, STG_QUOTES)
BOOK_CTES = (EV, BOOK_RAW, BOOK)
ALL_CTES = (EV, TRADES, STG_TRADES, QUOTES, STG_QUOTES)
