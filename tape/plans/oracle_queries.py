"""Oracle SQL (DuckDB) for each registered query, same column names."""

from __future__ import annotations

from tape.oracle import (BOOK_CTES, EV, LI_TRADES, QUOTE_CTES, STG_LI_TRADES, TRADE_CTES, half_up, with_)

_VWAP_SELECT = """SELECT symbol, date_trunc('minute', "timestamp") AS minute_bucket, trade_date,
  CASE WHEN sum(trade_size) = 0 THEN NULL ELSE sum(trade_notional) / sum(trade_size) END AS vwap,
  CAST(sum(trade_size) AS BIGINT) AS total_volume, sum(trade_notional) AS total_notional,
  count(*) AS trade_count, min(trade_price) AS low, max(trade_price) AS high,
  first(trade_price ORDER BY "timestamp", {tie}) AS open,
  first(trade_price ORDER BY "timestamp" DESC, {tie_desc}) AS close
FROM stg_trades WHERE NOT has_quality_issue
GROUP BY ALL"""

_PROFILE_SELECT = """SELECT symbol, trade_date, time_bucket(INTERVAL 5 MINUTE, "timestamp") AS bucket_start,
  CAST(sum(trade_size) AS BIGINT) AS bucket_volume, sum(trade_notional) AS bucket_notional,
  count(*) AS bucket_trade_count,
  CASE WHEN sum(trade_size) = 0 THEN NULL ELSE sum(trade_notional) / sum(trade_size) END AS bucket_vwap,
  min(trade_price) AS bucket_low, max(trade_price) AS bucket_high
FROM stg_trades WHERE NOT has_quality_issue
GROUP BY ALL"""

_SPREAD_SELECT = """SELECT symbol, date_trunc('{unit}', "timestamp") AS minute_bucket, quote_date,
  avg(spread_bps) AS avg_spread_bps, quantile_cont(spread_bps, 0.5) AS median_spread_bps,
  quantile_cont(spread_bps, 0.95) AS p95_spread_bps, min(spread_bps) AS min_spread_bps,
  max(spread_bps) AS max_spread_bps, avg(bid_size + ask_size) AS avg_depth,
  count(*) AS quote_count, CAST(count_if(has_quality_issue) AS BIGINT) AS quality_issue_count
FROM stg_quotes GROUP BY ALL"""

LI_TIE = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
LI_TIE_DESC = "l_orderkey DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC"

SQL: dict[str, str] = {
    "stg_trades": with_(*TRADE_CTES) + "SELECT * FROM stg_trades",
    "stg_quotes": with_(*QUOTE_CTES) + "SELECT * FROM stg_quotes",
    "book_enriched": with_(*BOOK_CTES) + "SELECT * FROM order_book_snapshots",
    "stg_order_book": with_(*BOOK_CTES) + """,
snap AS (SELECT symbol, "timestamp", CAST("timestamp" AS DATE) AS snap_date, bid_prices, bid_sizes,
  ask_prices, ask_sizes, mid_price, weighted_mid, book_imbalance, data_quality_flag <> 'OK' AS has_quality_issue
  FROM order_book_snapshots)
SELECT symbol, "timestamp", snap_date, 'bid' AS side, CAST(i AS INTEGER) AS level, bid_prices[i] AS price,
  bid_sizes[i] AS size, mid_price, weighted_mid, book_imbalance, has_quality_issue
FROM snap, range(1, len(bid_prices) + 1) r(i)
UNION ALL
SELECT symbol, "timestamp", snap_date, 'ask', CAST(i AS INTEGER), ask_prices[i], ask_sizes[i], mid_price,
  weighted_mid, book_imbalance, has_quality_issue
FROM snap, range(1, len(ask_prices) + 1) r(i)""",
    "int_vwap": with_(*TRADE_CTES) + _VWAP_SELECT.format(tie="tick_id", tie_desc="tick_id DESC"),
    "int_vwap_lineitem": with_(LI_TRADES, STG_LI_TRADES) + _VWAP_SELECT.format(tie=LI_TIE, tie_desc=LI_TIE_DESC),
    "int_volume_profile": with_(*TRADE_CTES) + _PROFILE_SELECT,
    "int_volume_profile_lineitem": with_(LI_TRADES, STG_LI_TRADES) + _PROFILE_SELECT,
    "int_spread_analytics": with_(*QUOTE_CTES) + _SPREAD_SELECT.format(unit="minute"),
    "spread_hourly": with_(*QUOTE_CTES) + _SPREAD_SELECT.format(unit="hour"),
}


# --- book depth ---------------------------------------------------------------


def _band(side: str, bps: int) -> str:
    """Size of one side's levels within ``bps`` of the mid, from the snapshot's
    lists; 0 on a flagged snapshot."""
    edge = (f"z[1] >= mid_price * (1::DOUBLE - {bps}::DOUBLE / 10000::DOUBLE)" if side == "bid"
            else f"z[1] <= mid_price * (1::DOUBLE + {bps}::DOUBLE / 10000::DOUBLE)")
    return (f"CASE WHEN data_quality_flag = 'OK' THEN coalesce(list_sum(list_transform(list_filter("
            f"list_zip({side}_prices, {side}_sizes), lambda z: {edge}), lambda z: z[2])), 0) ELSE 0 END")


# one row per snapshot, then averages per symbol-minute
DEPTH = f"""SELECT symbol, minute_bucket, snap_date,
  avg(mid_price) AS avg_mid_price, avg(weighted_mid) AS avg_weighted_mid, avg(bps) AS avg_bbo_spread_bps,
  quantile_cont(bps, 0.5) AS median_bbo_spread_bps, quantile_cont(bps, 0.95) AS p95_bbo_spread_bps,
  avg(best_bid) AS avg_tob_bid_size, avg(best_ask) AS avg_tob_ask_size,
  avg(near_bid) AS avg_depth_bid_5bps, avg(near_ask) AS avg_depth_ask_5bps,
  {half_up('avg(near_bid) / nullif(avg(near_bid) + avg(near_ask), 0)', 4)} AS depth_imbalance_5bps,
  avg(wide_bid) AS avg_depth_bid_10bps, avg(wide_ask) AS avg_depth_ask_10bps,
  {half_up('avg(wide_bid) / nullif(avg(wide_bid) + avg(wide_ask), 0)', 4)} AS depth_imbalance_10bps,
  avg(book_imbalance) AS avg_book_imbalance, quantile_cont(book_imbalance, 0.25) AS p25_book_imbalance,
  quantile_cont(book_imbalance, 0.75) AS p75_book_imbalance, count(*) AS snapshot_count
FROM (
  SELECT symbol, date_trunc('minute', "timestamp") AS minute_bucket, CAST("timestamp" AS DATE) AS snap_date,
    mid_price, weighted_mid, book_imbalance, bid_sizes[1] AS best_bid, ask_sizes[1] AS best_ask,
    CASE WHEN mid_price <> 0 THEN {half_up('(ask_prices[1] - bid_prices[1]) / mid_price * 10000::DOUBLE', 2)} END AS bps,
    {_band("bid", 5)} AS near_bid, {_band("ask", 5)} AS near_ask,
    {_band("bid", 10)} AS wide_bid, {_band("ask", 10)} AS wide_ask
  FROM order_book_snapshots)
GROUP BY symbol, minute_bucket, snap_date"""

SQL["int_order_book_depth"] = with_(*BOOK_CTES) + DEPTH
SQL["book_depth_arrays"] = SQL["int_order_book_depth"]

# --- quality findings -------------------------------------------------------------
from tape.oracle import BOOK, BOOK_RAW, QUOTES, STG_QUOTES, TRADES, STG_TRADES  # noqa: E402

RAW_CTES = (EV, TRADES, QUOTES)
_F = "source_table, symbol, event_time, issue_type, severity"

_CROSSED = """SELECT 'quotes' AS source_table, symbol, "timestamp" AS event_time, 'CROSSED_SPREAD' AS issue_type,
  'CRITICAL' AS severity, printf('bid=%.4f ask=%.4f spread=%.4f', bid_price, ask_price, bid_price - ask_price) AS details
FROM quotes WHERE bid_price > ask_price"""


def _stale(part="symbol"):
    return f"""SELECT 'quotes' AS source_table, symbol, "timestamp" AS event_time, 'STALE_QUOTE' AS issue_type,
  'WARNING' AS severity,
  'gap_seconds=' || CAST((gap_us + 5000) // 10000 // 100 AS VARCHAR) || '.'
    || lpad(CAST((gap_us + 5000) // 10000 % 100 AS VARCHAR), 2, '0') AS details, gap_us
FROM (SELECT symbol, "timestamp", epoch_us("timestamp") - epoch_us(lag("timestamp") OVER (PARTITION BY {part}
        ORDER BY "timestamp", tick_id)) AS gap_us
      FROM quotes WHERE hour("timestamp") >= 14 AND hour("timestamp") < 21)
WHERE gap_us > 5000000"""


def _outlier(src="trades", tie="tick_id"):
    return f"""SELECT 'trades' AS source_table, symbol, "timestamp" AS event_time, 'PRICE_OUTLIER' AS issue_type,
  'CRITICAL' AS severity,
  printf('price=%.2f rolling_mean=%.2f rolling_std=%.4f z_score=%.2f', {half_up('trade_price', 2)}, {half_up('rm', 2)},
         {half_up('rs', 4)}, {half_up('z', 2)}) AS details, trade_price
FROM (SELECT *, CASE WHEN rs > 0 THEN abs(trade_price - rm) / rs ELSE 0 END AS z
      FROM (SELECT symbol, "timestamp", trade_price, avg(trade_price) OVER w AS rm, stddev_pop(trade_price) OVER w AS rs
            FROM {src} WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp", {tie}
                                    ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)))
WHERE z > 3 AND rs > 0"""


_ZERO_T = """SELECT 'trades' AS source_table, symbol, "timestamp" AS event_time, 'MISSING_FIELD' AS issue_type,
  'WARNING' AS severity, 'trade_size is 0' AS details FROM trades WHERE trade_size = 0"""
_ZERO_Q = """SELECT 'quotes' AS source_table, symbol, "timestamp" AS event_time, 'MISSING_FIELD' AS issue_type,
  'WARNING' AS severity, 'bid_size=' || CAST(bid_size AS VARCHAR) || ' ask_size=' || CAST(ask_size AS VARCHAR) AS details
FROM quotes WHERE bid_size = 0 OR ask_size = 0"""

ISSUES_CTE = f"""issues AS (
  SELECT TIMESTAMP '2025-01-01 00:00:00' AS detected_at, * FROM (
  {_CROSSED}
  UNION ALL SELECT {_F}, details FROM ({_stale()})
  UNION ALL SELECT {_F}, details FROM ({_outlier()})
  UNION ALL {_ZERO_T}
  UNION ALL {_ZERO_Q}))"""

SQL.update({
    "dq_crossed": with_(*RAW_CTES) + _CROSSED,
    "dq_stale": with_(*RAW_CTES) + _stale(),
    "dq_stale_blocked": with_(*RAW_CTES) + _stale(),
    "dq_stale_daily": with_(*RAW_CTES) + _stale('symbol, CAST("timestamp" AS DATE)'),
    "dq_outlier": with_(*RAW_CTES) + f"SELECT {_F}, trade_price FROM ({_outlier()})",
    "dq_outlier_halo": with_(*RAW_CTES) + f"SELECT {_F}, trade_price FROM ({_outlier()})",
    "dq_outlier_lineitem": with_(LI_TRADES) + f"SELECT {_F}, trade_price FROM ({_outlier(tie=LI_TIE)})",
    "dq_zero_trades": with_(*RAW_CTES) + _ZERO_T,
    "dq_zero_quotes": with_(*RAW_CTES) + _ZERO_Q,
    "dq_scan": with_(*RAW_CTES, ISSUES_CTE) + "SELECT source_table, symbol, event_time, issue_type, severity, details FROM issues",
    "dq_incremental": with_(*RAW_CTES, ISSUES_CTE) + f"""SELECT {_F} FROM issues
WHERE issue_type IN ('STALE_QUOTE', 'PRICE_OUTLIER')""",
    "dq_summary": with_(*RAW_CTES, ISSUES_CTE) + """SELECT issue_type, severity, count(*) AS cnt,
  count(DISTINCT symbol) AS symbols_affected, min(event_time) AS first_seen, max(event_time) AS last_seen
FROM issues GROUP BY issue_type, severity""",
    "dq_rate": with_(*RAW_CTES, ISSUES_CTE) + """SELECT *, CASE WHEN trade_rows + quote_rows = 0 THEN NULL
  ELSE CAST(total_issues AS DOUBLE) / CAST(trade_rows + quote_rows AS DOUBLE) * CAST(100 AS DOUBLE) END AS issue_pct
FROM (SELECT (SELECT count(*) FROM issues) AS total_issues, (SELECT count(*) FROM trades) AS trade_rows,
             (SELECT count(*) FROM quotes) AS quote_rows)""",
})

# --- marts ------------------------------------------------------------------------
# open and close are the first and last of the day's numbered trades
DAILY_CTE = """numbered AS (
  SELECT *, row_number() OVER day_order AS nth, count(*) OVER (PARTITION BY symbol, trade_date) AS of_n
  FROM stg_trades WINDOW day_order AS (PARTITION BY symbol, trade_date ORDER BY "timestamp", tick_id)),
spreads AS (
  SELECT symbol, quote_date, avg(spread_bps) AS mean_bps, quantile_cont(spread_bps, [0.5, 0.95]) AS q,
    count(*) AS n, count(*) FILTER (has_quality_issue) AS flagged
  FROM stg_quotes GROUP BY ALL),
mart_daily_summary AS (
  SELECT d.*, s.mean_bps AS avg_spread_bps, s.q[1] AS median_spread_bps, s.q[2] AS p95_spread_bps,
    coalesce(s.n, 0) AS quote_count, (d_flagged + coalesce(s.flagged, 0))::BIGINT AS total_quality_issues,
    (close_price - open_price) / nullif(open_price, 0) * 100::DOUBLE AS daily_return_pct
  FROM (SELECT symbol, trade_date, any_value(trade_price) FILTER (nth = 1) AS open_price, max(trade_price) AS high_price,
      min(trade_price) AS low_price, any_value(trade_price) FILTER (nth = of_n) AS close_price,
      sum(trade_size)::BIGINT AS total_volume, sum(trade_notional) AS total_notional,
      sum(trade_notional) / nullif(sum(trade_size), 0) AS day_vwap, count(*) AS trade_count,
      count(*) FILTER (has_quality_issue) AS d_flagged
    FROM numbered GROUP BY symbol, trade_date) d
  LEFT JOIN spreads s ON s.symbol = d.symbol AND s.quote_date = d.trade_date)"""

STAGED = (EV, TRADES, STG_TRADES, QUOTES, STG_QUOTES)

DQ_MART_CTE = """mart_data_quality_summary AS (
  SELECT trade_date AS issue_date, symbol, data_quality_flag AS issue_type, 'trades' AS source_table,
    count(*) AS issue_count FROM stg_trades WHERE has_quality_issue GROUP BY ALL
  UNION ALL
  SELECT quote_date, symbol, data_quality_flag, 'quotes', count(*) FROM stg_quotes WHERE has_quality_issue
  GROUP BY ALL)"""

SQL.update({
    "mart_daily_summary": with_(*STAGED, DAILY_CTE) + "SELECT * EXCLUDE (d_flagged) FROM mart_daily_summary",
    "mart_data_quality_summary": with_(*STAGED, DQ_MART_CTE) + "SELECT * FROM mart_data_quality_summary",
})

# --- table checks -------------------------------------------------------------------
from tape.operators.checks import NOT_NULL  # noqa: E402

_VWAP_CTE = "int_vwap AS (" + _VWAP_SELECT.format(tie="tick_id", tie_desc="tick_id DESC") + ")"
_SPREAD_CTE = "int_spread_analytics AS (" + _SPREAD_SELECT.format(unit="minute") + ")"
_BOOK_LEVELS_CTE = "stg_order_book AS (WITH " + SQL["stg_order_book"][len(with_(*BOOK_CTES)):].lstrip(" ,\n") + ")"
_DEPTH_CTE = f"int_order_book_depth AS ({DEPTH})"
# the raw tables as q_chk_not_null makes them: some values missing
_HOLES = ", ".join(f"""{t}_h AS (SELECT * REPLACE (CASE WHEN tick_id % {k} = 5 THEN NULL ELSE {c} END AS {c}) FROM {t})"""
                   for t, c, k in (("trades", "trade_price", 97), ("quotes", "bid_price", 89), ("order_book_snapshots", "mid_price", 83)))
SQL["chk_not_null"] = (
    with_(*STAGED, *[c for c in BOOK_CTES if c not in STAGED], DAILY_CTE, DQ_MART_CTE, _VWAP_CTE, _SPREAD_CTE, _BOOK_LEVELS_CTE, _DEPTH_CTE, _HOLES)
    + "SELECT * FROM (" + "\nUNION ALL ".join(
        f"""SELECT '{m}' AS model, '{c}' AS column_name, CAST(count_if("{c}" IS NULL) AS BIGINT) AS null_rows
  FROM {m + '_h' if m in ('trades', 'quotes', 'order_book_snapshots') else m}""" for m, cols in NOT_NULL.items() for c in cols)
    + ") WHERE null_rows > 0")

from tape.schemas import QUOTE_FLAGS, SIDES, TRADE_FLAGS  # noqa: E402


def _in(vals):
    return "(" + ", ".join(f"'{v}'" for v in vals) + ")"


SQL["chk_accepted"] = with_(*STAGED, BOOK_RAW, BOOK) + f"""SELECT data_quality_flag AS value, count(*) AS n_records,
  'trade_flag_generated' AS test FROM stg_trades WHERE data_quality_flag NOT IN ('OK', 'MISSING_FIELD') GROUP BY 1
UNION ALL SELECT data_quality_flag, count(*), 'quote_flag' FROM stg_quotes
  WHERE data_quality_flag NOT IN {_in(QUOTE_FLAGS)} GROUP BY 1
UNION ALL SELECT side, count(*), 'book_side' FROM (SELECT unnest(['bid', 'ask']) AS side FROM order_book_snapshots)
  WHERE side NOT IN {_in(SIDES)} GROUP BY 1
UNION ALL SELECT data_quality_flag, count(*), 'trade_flag' FROM stg_trades
  WHERE data_quality_flag NOT IN {_in(TRADE_FLAGS)} GROUP BY 1"""

SQL["chk_dup"] = with_(LI_TRADES, STG_LI_TRADES) + """SELECT symbol, "timestamp", count(*) AS row_count
FROM stg_trades GROUP BY ALL HAVING count(*) > 1"""
SQL["chk_dup_quotes"] = with_(*QUOTE_CTES) + """SELECT symbol, "timestamp", count(*) AS row_count
FROM stg_quotes GROUP BY ALL HAVING count(*) > 1"""
SQL["chk_future"] = with_(*TRADE_CTES) + """SELECT symbol, "timestamp", trade_price FROM stg_trades
WHERE "timestamp" > TIMESTAMP '2024-01-30 12:00:00'"""
SQL["chk_vwap_range"] = with_(*STAGED, DAILY_CTE) + """SELECT symbol, trade_date, day_vwap, close_price,
  CASE WHEN close_price = 0 THEN NULL ELSE abs(day_vwap - close_price) / close_price END * CAST(100 AS DOUBLE)
    AS deviation_pct
FROM mart_daily_summary WHERE abs(day_vwap - close_price) / close_price > CAST(0.05 AS DOUBLE)"""

# --- reports ------------------------------------------------------------------------
_S, _E = "TIMESTAMP '2024-01-03 00:00:00'", "TIMESTAMP '2024-01-28 23:59:59'"
_DS, _DE = "DATE '2024-01-03'", "DATE '2024-01-28'"
_SYMS = "('click_0', 'click_1', 'view_2', 'purchase_3', 'error_4', 'signup_0')"
_ONE = "'click_2'"
_PROFILE_CTE = "int_volume_profile AS (" + _PROFILE_SELECT + ")"
_REP = with_(*STAGED, DAILY_CTE, _VWAP_CTE, _SPREAD_CTE, _PROFILE_CTE)
_REP_ISSUES = with_(*STAGED, ISSUES_CTE)


def _tw(col, syms=_SYMS):
    c = f"{col} >= {_S} AND {col} <= {_E}"
    if syms:
        c += f" AND symbol {'IN' if syms.startswith('(') else '='} {syms}"
    return c


SQL.update({
    "rep_vwap_series": _REP + f"SELECT minute_bucket AS time, symbol, vwap FROM int_vwap WHERE {_tw('minute_bucket')}",
    "rep_volume_by_symbol": _REP + f"""SELECT symbol, CAST(sum(total_volume) AS BIGINT) AS volume FROM int_vwap
WHERE {_tw('minute_bucket', None)} GROUP BY symbol""",
    "rep_spread_heatmap": _REP + f"""SELECT date_trunc('hour', minute_bucket) AS time, symbol, avg(avg_spread_bps) AS spread
FROM int_spread_analytics WHERE {_tw('minute_bucket')} GROUP BY ALL""",
    "rep_volume_time_of_day": _REP + f"""SELECT strftime(bucket_start, '%H:%M:%S') AS time_of_day,
  CAST(sum(bucket_volume) AS BIGINT) AS volume FROM int_volume_profile WHERE {_tw('bucket_start')} GROUP BY ALL""",
    "rep_daily_table": _REP + f"""SELECT symbol, trade_date, open_price, high_price, low_price, close_price, total_volume,
  day_vwap, avg_spread_bps, total_quality_issues, round(daily_return_pct, 3) AS return_pct FROM mart_daily_summary
WHERE trade_date >= {_DS} AND trade_date <= {_DE} AND symbol IN {_SYMS}""",
    "rep_tick_chart": _REP + f"""SELECT "timestamp" AS time, trade_price FROM trades
WHERE {_tw('"timestamp"', _ONE)} AND data_quality_flag = 'OK'""",
    "rep_ohlc": _REP + f"SELECT minute_bucket AS time, open, high, low, close FROM int_vwap WHERE {_tw('minute_bucket', _ONE)}",
    "rep_spread_evolution": _REP + f"""SELECT minute_bucket AS time, avg_spread_bps, p95_spread_bps FROM int_spread_analytics
WHERE {_tw('minute_bucket', _ONE)}""",
    "rep_volume_buckets": _REP + f"""SELECT bucket_start AS time, bucket_volume AS volume FROM int_volume_profile
WHERE {_tw('bucket_start', _ONE)}""",
    "rep_size_histogram": _REP + f"""SELECT CAST(floor(trade_size / 10) * 10 AS BIGINT) AS bin_start, count(*) AS trades
FROM trades WHERE {_tw('"timestamp"', _ONE)} AND data_quality_flag = 'OK' GROUP BY ALL""",
    "rep_daily_stats": _REP + f"""SELECT trade_date, open_price, high_price, low_price, close_price, total_volume, day_vwap,
  round(avg_spread_bps, 2) AS spread_bps, total_quality_issues, round(daily_return_pct, 3) AS return_pct
FROM mart_daily_summary WHERE symbol = {_ONE}""",
    "rep_symbol_issues": _REP_ISSUES + f"""SELECT event_time, source_table, issue_type, severity, details FROM issues
WHERE {_tw('event_time', _ONE)}
ORDER BY event_time DESC, source_table, issue_type, severity, details LIMIT 100""",
    "rep_issues_over_time": _REP_ISSUES + f"""SELECT date_trunc('hour', event_time) AS time, issue_type, count(*) AS cnt
FROM issues WHERE {_tw('event_time')} GROUP BY ALL""",
    "rep_issue_types": _REP_ISSUES + f"""SELECT issue_type, count(*) AS cnt FROM issues WHERE {_tw('event_time')}
GROUP BY ALL""",
    "rep_issues_by_symbol": _REP_ISSUES + f"""SELECT symbol, issue_type, count(*) AS cnt FROM issues
WHERE {_tw('event_time', None)} GROUP BY ALL ORDER BY cnt DESC, symbol, issue_type LIMIT 50""",
    "rep_severity": _REP_ISSUES + f"""SELECT severity, count(*) AS cnt FROM issues WHERE {_tw('event_time', None)}
GROUP BY ALL""",
    "rep_quality_rate": _REP_ISSUES + """SELECT round(CAST(100 AS DOUBLE) - CAST((SELECT count(*) FROM issues) AS DOUBLE)
  / CAST((SELECT count(*) FROM trades) + (SELECT count(*) FROM quotes) AS DOUBLE) * CAST(100 AS DOUBLE), 3) AS quality_pct""",
    "rep_recent_issues": _REP_ISSUES + f"""SELECT detected_at, source_table, symbol, event_time, issue_type, severity, details
FROM issues WHERE {_tw('event_time')}
ORDER BY event_time DESC, detected_at, source_table, symbol, issue_type, severity, details LIMIT 200""",
    "rep_symbols": _REP + "SELECT DISTINCT symbol FROM trades",
})

SQL["dq_scan_slices"] = SQL["dq_scan"]
SQL["size_outliers"] = with_(*RAW_CTES) + """, sized AS (
  SELECT symbol, "timestamp", tick_id, CASE WHEN tick_id % 53 = 7 THEN trade_size * 1000 ELSE trade_size END AS trade_size FROM trades),
framed AS (
  SELECT *, CAST(median(trade_size) OVER w AS DOUBLE) AS rolling_median, CAST(mad(CAST(trade_size AS DOUBLE)) OVER w AS DOUBLE) AS rolling_mad
  FROM sized WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp", tick_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW))
SELECT * FROM framed WHERE rolling_mad > 0 AND abs(trade_size - rolling_median) > CAST(6.0 * 1.4826 AS DOUBLE) * rolling_mad"""
SQL["daily_summary_declared"] = SQL["mart_daily_summary"]
SQL["spread_sketches"] = with_(*QUOTE_CTES) + """SELECT symbol, count(spread_bps) AS n, true AS median_spread_bps_within,
  true AS p95_spread_bps_within FROM stg_quotes WHERE spread_bps IS NOT NULL GROUP BY symbol"""
SQL["symbols_by_view"] = with_(*TRADE_CTES) + """SELECT symbol, count(*) AS trade_count, CAST(sum(trade_size) AS BIGINT) AS total_volume
FROM stg_trades WHERE NOT has_quality_issue GROUP BY symbol"""

# --- sources, flags, calendar, as-of ------------------------------------------------------
SQL.update({
    "csv_roundtrip": with_(*RAW_CTES) + """SELECT symbol, "timestamp", trade_price, trade_size, exchange, trade_condition,
  data_quality_flag FROM trades""",
    "book_csv_roundtrip": with_(*BOOK_CTES) + """SELECT symbol, "timestamp", bid_prices, bid_sizes, ask_prices, ask_sizes,
  mid_price, weighted_mid, book_imbalance, data_quality_flag FROM order_book_snapshots""",
    "load_quarantine": with_(*RAW_CTES) + """, k AS (
  SELECT *, unnest(CASE WHEN bad THEN list_concat(['any'], list_filter(faults, lambda f: f IS NOT NULL)) ELSE [''] END) AS fault
  FROM (SELECT tick_id % 101 AS k, tick_id % 101 IN (3, 5, 7, 11, 17, 19, 23) AS bad,
          [CASE WHEN tick_id % 101 IN (3, 7) THEN 'malformed' END, CASE WHEN tick_id % 101 = 5 THEN 'null trade_price' END,
           CASE WHEN tick_id % 101 = 19 THEN 'null symbol' END, CASE WHEN tick_id % 101 IN (17, 23) THEN 'domain trade_size' END,
           CASE WHEN tick_id % 101 IN (11, 23) THEN 'domain data_quality_flag' END] AS faults
        FROM trades))
SELECT 'trades' AS "table", CASE WHEN bad THEN 'bad' ELSE 'good' END AS verdict, fault, count(*) AS n_rows FROM k GROUP BY ALL""",
    "partitioned_load": with_(*TRADE_CTES) + """SELECT 'stg_trades' AS "table", count(*) AS source_rows,
  count(*) AS written_rows, true AS match FROM stg_trades""",
    "flag_rules_quotes": with_(*RAW_CTES) + """SELECT symbol, "timestamp", tick_id,
  CASE WHEN bid_price > ask_price THEN 'CROSSED_SPREAD'
       WHEN bid_size = 0 OR ask_size = 0 OR bid_size IS NULL OR ask_size IS NULL THEN 'MISSING_FIELD'
       WHEN (CASE WHEN bid_price > 0 THEN (ask_price - bid_price) / ((bid_price + ask_price) / CAST(2 AS DOUBLE))
             * CAST(10000 AS DOUBLE) END) > CAST(50 AS DOUBLE) THEN 'WIDE_SPREAD'
       ELSE 'OK' END AS data_quality_flag FROM quotes""",
    "flag_rules_book": with_(EV, BOOK_RAW) + """SELECT symbol, "timestamp", tick_id,
  CASE WHEN bid_prices[1] > ask_prices[1] THEN 'CROSSED_BOOK'
       WHEN list_bool_or(list_transform(bid_prices, lambda p: p <= 0))
         OR list_bool_or(list_transform(ask_prices, lambda p: p <= 0)) THEN 'MISSING_LEVELS'
       ELSE 'OK' END AS data_quality_flag FROM book_raw""",
    "trading_days": with_(*RAW_CTES) + """SELECT CAST(d AS DATE) AS trade_date,
  CAST(d AS TIMESTAMP) + INTERVAL 14 HOUR + INTERVAL 30 MINUTE AS session_open,
  CAST(d AS TIMESTAMP) + INTERVAL 21 HOUR AS session_close
FROM (SELECT unnest(generate_series(min(CAST("timestamp" AS DATE)), max(CAST("timestamp" AS DATE)), INTERVAL 1 DAY)) AS d
      FROM trades) WHERE isodow(d) < 6""",
    "asof_trade_quote": with_(*RAW_CTES) + """SELECT t.symbol, t."timestamp", t.tick_id, t.trade_price, t.trade_size,
  q."timestamp" AS q_timestamp, q.bid_price AS q_bid_price, q.ask_price AS q_ask_price
FROM trades t ASOF LEFT JOIN quotes q ON t.symbol = q.symbol AND t."timestamp" > q."timestamp\"""",
    "flag_rules_trades": with_(*RAW_CTES) + """SELECT symbol, "timestamp", tick_id,
  CASE WHEN trade_size = 0 OR trade_size IS NULL THEN 'MISSING_FIELD'
       WHEN (CASE WHEN q_mid = 0 THEN NULL ELSE abs(trade_price - q_mid) / q_mid END) * CAST(100 AS DOUBLE)
            > CAST(5 AS DOUBLE) THEN 'PRICE_OUTLIER'
       ELSE 'OK' END AS data_quality_flag
FROM (SELECT t.*, (q.bid_price + q.ask_price) / CAST(2 AS DOUBLE) AS q_mid
      FROM trades t ASOF LEFT JOIN quotes q ON t.symbol = q.symbol AND t."timestamp" > q."timestamp")""",
})

# --- pipeline and streaming ------------------------------------------------------------
SQL.update({
    "batch_run_daily_summary": SQL["mart_daily_summary"],
    "stream_vwap_bars": with_(*TRADE_CTES, _VWAP_CTE) + "SELECT * FROM int_vwap",
    "stream_dedup": with_(*RAW_CTES) + "SELECT * FROM trades",
    "stream_stale": with_(*RAW_CTES) + _stale(),
    "stream_checks_sink": with_(*RAW_CTES) + f"{_CROSSED}\nUNION ALL {_ZERO_Q}\nUNION ALL {_ZERO_T}",
})

SQL.update({
    "stream_volume_profile": with_(*TRADE_CTES, _PROFILE_CTE) + "SELECT * FROM int_volume_profile",
    "chk_dup_rows": with_(LI_TRADES, STG_LI_TRADES) + """SELECT symbol, "timestamp", trade_date, trade_price, trade_size,
  trade_notional, exchange, trade_condition, data_quality_flag, has_quality_issue, count(*) AS row_count
FROM stg_trades GROUP BY ALL HAVING count(*) > 1""",
})

SQL["rep_size_sample"] = _REP + f"""SELECT "timestamp", tick_id, trade_size FROM trades
WHERE {_tw('"timestamp"', _ONE)} AND data_quality_flag = 'OK' ORDER BY "timestamp", tick_id"""

SQL["daily_spread_quantiles"] = with_(*QUOTE_CTES) + """SELECT symbol, quote_date,
  quantile_cont(spread_bps, 0.5) AS median_spread_bps, quantile_cont(spread_bps, 0.95) AS p95_spread_bps
FROM stg_quotes GROUP BY symbol, quote_date"""

SQL["asof_trade_quote_bucketed"] = SQL["asof_trade_quote"]

SQL["dq_outlier_range"] = SQL["dq_outlier_lineitem"]


SQL["flag_rules"] = with_(*RAW_CTES, BOOK_RAW) + f"""SELECT *, 'trades' AS source_table FROM (
  SELECT symbol, "timestamp", tick_id,
    CASE WHEN trade_size = 0 OR trade_size IS NULL THEN 'MISSING_FIELD'
         WHEN (CASE WHEN q_mid = 0 THEN NULL ELSE abs(trade_price - q_mid) / q_mid END) * CAST(100 AS DOUBLE)
              > CAST(5 AS DOUBLE) THEN 'PRICE_OUTLIER'
         ELSE 'OK' END AS data_quality_flag
  FROM (SELECT t.*, (q.bid_price + q.ask_price) / CAST(2 AS DOUBLE) AS q_mid
        FROM trades t ASOF LEFT JOIN quotes q ON t.symbol = q.symbol AND t."timestamp" > q."timestamp"))
UNION ALL
SELECT symbol, "timestamp", tick_id,
  CASE WHEN bid_price > ask_price THEN 'CROSSED_SPREAD'
       WHEN bid_size = 0 OR ask_size = 0 OR bid_size IS NULL OR ask_size IS NULL THEN 'MISSING_FIELD'
       WHEN (CASE WHEN bid_price > 0 THEN (ask_price - bid_price) / ((bid_price + ask_price) / CAST(2 AS DOUBLE))
             * CAST(10000 AS DOUBLE) END) > CAST(50 AS DOUBLE) THEN 'WIDE_SPREAD'
       ELSE 'OK' END, 'quotes' FROM quotes
UNION ALL
SELECT symbol, "timestamp", tick_id,
  CASE WHEN bid_prices[1] > ask_prices[1] THEN 'CROSSED_BOOK'
       WHEN list_bool_or(list_transform(bid_prices, lambda p: p <= 0))
         OR list_bool_or(list_transform(ask_prices, lambda p: p <= 0)) THEN 'MISSING_LEVELS'
       ELSE 'OK' END, 'order_book_snapshots' FROM book_raw"""

# --- what one run of the batch pipeline writes -------------------------------------------
SQL["batch_run_depth"] = SQL["int_order_book_depth"]
SQL["batch_run_issues"] = SQL["dq_scan"]
SQL["batch_run_summary"] = SQL["dq_summary"]


def _watched(name: str) -> list[str]:
    """Rows of the checks that are counted while model ``name`` passes."""
    out = [f"SELECT 'not_null:{name}', '{c}', count(*) FILTER ({c} IS NULL) FROM {name}" for c in NOT_NULL[name]]
    if name in ("stg_trades", "stg_quotes"):
        flags = ", ".join(f"'{v}'" for v in (TRADE_FLAGS if name == "stg_trades" else QUOTE_FLAGS))
        out += [f"SELECT 'accepted_values:{name}.data_quality_flag', '', count(*) FILTER (data_quality_flag NOT IN ({flags})) FROM {name}",
                f"SELECT 'no_future:{name}', '', count(*) FILTER (\"timestamp\" > TIMESTAMP '2025-01-01') FROM {name}",
                f"SELECT 'no_duplicates:{name}', '', count(*) FROM (SELECT 1 FROM {name} GROUP BY symbol, \"timestamp\" HAVING count(*) > 1)"]
    return out


_CHECKED = ["stg_trades", "stg_quotes", "int_vwap", "int_spread_analytics", "int_order_book_depth", "mart_daily_summary", "mart_data_quality_summary"]
SQL["batch_run_checks"] = (
    with_(*STAGED, *[c for c in BOOK_CTES if c not in STAGED], DAILY_CTE, DQ_MART_CTE, _VWAP_CTE, _SPREAD_CTE, _DEPTH_CTE)
    + "SELECT test, detail, CAST(n AS BIGINT) AS failing_rows FROM (\n"
    + "\nUNION ALL ".join([
        *[q for name in _CHECKED for q in _watched(name)],
        "SELECT 'vwap_within_range', '', count(*) FROM mart_daily_summary WHERE abs(day_vwap - close_price) / close_price > CAST(0.05 AS DOUBLE)",
        *[f"SELECT 'load:{t}', 'good', count(*) FROM {t}" for t in ("trades", "quotes", "order_book_snapshots")]])
    + ") AS c(test, detail, n)")

SQL["chk_future_quotes"] = with_(*QUOTE_CTES) + """SELECT symbol, "timestamp", bid_price, ask_price FROM stg_quotes
WHERE "timestamp" > TIMESTAMP '2024-01-30 12:00:00'"""
SQL["tick_time_forms"] = with_(*RAW_CTES) + """SELECT tick_id, epoch_us("timestamp") AS epoch_us,
  strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f') AS time_text, "timestamp" AS back,
  date_diff('millisecond', date_trunc('day', "timestamp") + INTERVAL 12 HOUR, "timestamp") AS noon_ms FROM trades"""
