"""Report queries (R1–R19, F1–F6): parameterised ``DataFrame`` functions over
the model tables.  The caller decides when to collect.

Common arguments: ``start``/``end`` (inclusive, timestamps or ISO strings),
``symbols`` (None = all, a string = one symbol, a list = IN).  The time
predicate is repeated on the model's date column so day-partitioned tables
are pruned at the scan (O5).  Every top-k orders on all output columns after
the ranking measure, so ties resolve the same way on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tape.functions.time import _day, _utc, time_filter, time_of_day, truncate, ts_type


def _symbols(symbols) -> Column:
    if symbols is None:
        return F.lit(True)
    if isinstance(symbols, str):
        return F.col("symbol") == symbols
    return F.col("symbol").isin(list(symbols))


def _window(df: DataFrame, ts: str, start, end, symbols=None, date_col: str | None = None) -> DataFrame:
    """Rows of a time range; on the raw tables and the issue log the day column
    that they are partitioned by (``DAY_COLUMNS``) is used where it is there."""
    if date_col is None and DAY_COLUMNS.get(ts) in df.columns:
        date_col = DAY_COLUMNS[ts]
    return df.where(time_filter(ts, start, end, date_col) & _symbols(symbols))


#: Day partition column by time column, as the writers name them.
DAY_COLUMNS = {"timestamp": "date", "event_time": "event_date", "detected_at": "detected_date"}


def _date_window(df: DataFrame, date_col: str, start, end, symbols=None) -> DataFrame:
    return df.where(time_filter(date_col, _as_day(start), _as_day(end)) & _symbols(symbols))


def _as_day(v):
    """The UTC day of a bound."""
    return None if v is None else _day(_utc(v))


# --- market overview ---------------------------------------------------------------
def vwap_series(int_vwap: DataFrame, start=None, end=None, symbols=None) -> DataFrame:
    """Minute VWAP per symbol over time."""
    return (_window(int_vwap, "minute_bucket", start, end, symbols, "trade_date")
            .select(F.col("minute_bucket").alias("time"), "symbol", "vwap")
            .orderBy("time", "symbol"))


def volume_by_symbol(int_vwap: DataFrame, start=None, end=None, symbols=None) -> DataFrame:
    """R2: total volume per symbol, largest first."""
    return (_window(int_vwap, "minute_bucket", start, end, symbols, "trade_date")
            .groupBy("symbol").agg(F.sum("total_volume").alias("volume"))
            .orderBy(F.desc("volume"), "symbol"))


def spread_heatmap(int_spread: DataFrame, start=None, end=None, symbols=None) -> DataFrame:
    """Mean of the minute mean spreads per symbol and hour (not quote-weighted)."""
    hour = truncate("minute_bucket", "hour", ts_type(int_spread, "minute_bucket")).alias("time")
    return (_window(int_spread, "minute_bucket", start, end, symbols, "quote_date")
            .groupBy(hour, "symbol").agg(F.avg("avg_spread_bps").alias("spread"))
            .orderBy("time", "symbol"))


def volume_by_time_of_day(int_profile: DataFrame, start=None, end=None, symbols=None) -> DataFrame:
    """Volume per 5-minute time of day across days."""
    return (_window(int_profile, "bucket_start", start, end, symbols, "trade_date")
            .groupBy(time_of_day("bucket_start").alias("time_of_day"))
            .agg(F.sum("bucket_volume").alias("volume"))
            .orderBy("time_of_day"))


def daily_summary_table(mart: DataFrame, start=None, end=None, symbols=None) -> DataFrame:
    """The daily mart for a date range, newest first."""
    return (_date_window(mart, "trade_date", start, end, symbols)
            .select("symbol", "trade_date", "open_price", "high_price", "low_price", "close_price",
                    "total_volume", "day_vwap", "avg_spread_bps", "total_quality_issues",
                    F.round("daily_return_pct", 3).alias("return_pct"))
            .orderBy(F.desc("trade_date"), "symbol"))


# --- symbol deep dive ------------------------------------------------------------------
def tick_chart(trades: DataFrame, symbol: str, start=None, end=None) -> DataFrame:
    """Clean raw trades of one symbol."""
    return (_window(trades, "timestamp", start, end, symbol)
            .where(F.col("data_quality_flag") == "OK")
            .select(F.col("timestamp").alias("time"), "trade_price")
            .orderBy("time"))


def ohlc(int_vwap: DataFrame, symbol: str, start=None, end=None) -> DataFrame:
    """One-minute candles."""
    return (_window(int_vwap, "minute_bucket", start, end, symbol, "trade_date")
            .select(F.col("minute_bucket").alias("time"), "open", "high", "low", "close")
            .orderBy("time"))


def spread_evolution(int_spread: DataFrame, symbol: str, start=None, end=None) -> DataFrame:
    """Minute mean and p95 spread."""
    return (_window(int_spread, "minute_bucket", start, end, symbol, "quote_date")
            .select(F.col("minute_bucket").alias("time"), "avg_spread_bps", "p95_spread_bps")
            .orderBy("time"))


def volume_by_bucket(int_profile: DataFrame, symbol: str, start=None, end=None) -> DataFrame:
    """Volume per 5-minute bucket."""
    return (_window(int_profile, "bucket_start", start, end, symbol, "trade_date")
            .select(F.col("bucket_start").alias("time"), F.col("bucket_volume").alias("volume"))
            .orderBy("time"))


def trade_size_histogram(trades: DataFrame, symbol: str, start=None, end=None, width: int = 10) -> DataFrame:
    """Trade-size distribution binned in Spark over all matching trades
    (the source shipped up to 100,000 raw sizes to the client to bin)."""
    b = (F.floor(F.col("trade_size") / F.lit(width)) * F.lit(width)).cast("long")
    return (_window(trades, "timestamp", start, end, symbol)
            .where(F.col("data_quality_flag") == "OK")
            .groupBy(b.alias("bin_start")).agg(F.count(F.lit(1)).alias("trades"))
            .orderBy("bin_start"))


def trade_sizes(trades: DataFrame, symbol: str, start=None, end=None, tie: Sequence[str] = ()) -> DataFrame:
    """the raw panel form — every clean trade size of the range in time
    order (the source sent the first 100,000 to the client)."""
    return (_window(trades, "timestamp", start, end, symbol)
            .where(F.col("data_quality_flag") == "OK")
            .select("timestamp", *tie, "trade_size")
            .orderBy("timestamp", *tie))


def daily_stats(mart: DataFrame, symbol: str) -> DataFrame:
    """Every day of one symbol, newest first (no time filter)."""
    return (mart.where(F.col("symbol") == symbol)
            .select("trade_date", "open_price", "high_price", "low_price", "close_price", "total_volume",
                    "day_vwap", F.round("avg_spread_bps", 2).alias("spread_bps"), "total_quality_issues",
                    F.round("daily_return_pct", 3).alias("return_pct"))
            .orderBy(F.desc("trade_date")))


def symbol_issues(issues: DataFrame, symbol: str, start=None, end=None, k: int = 100) -> DataFrame:
    """Latest ``k`` findings of one symbol by event time."""
    return (_window(issues, "event_time", start, end, symbol)
            .select("event_time", "source_table", "issue_type", "severity", "details")
            .orderBy(F.desc("event_time"), "source_table", "issue_type", "severity", "details")
            .limit(k))


# --- data quality monitor ------------------------------------------------------------------
def issues_over_time(issues: DataFrame, start=None, end=None, symbols=None,
                     time_col: str = "detected_at") -> DataFrame:
    """Findings per hour and type."""
    hour = truncate(time_col, "hour", ts_type(issues, time_col)).alias("time")
    return (_window(issues, time_col, start, end, symbols)
            .groupBy(hour, "issue_type").agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy("time", "issue_type"))


def issue_count_by_type(issues: DataFrame, start=None, end=None, symbols=None,
                        time_col: str = "detected_at") -> DataFrame:
    """R14."""
    return (_window(issues, time_col, start, end, symbols)
            .groupBy("issue_type").agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), "issue_type"))


def issues_by_symbol(issues: DataFrame, start=None, end=None, k: int = 50,
                     time_col: str = "detected_at") -> DataFrame:
    """Top ``k`` (symbol, type) pairs by count."""
    return (_window(issues, time_col, start, end)
            .groupBy("symbol", "issue_type").agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), "symbol", "issue_type")
            .limit(k))


def severity_breakdown(issues: DataFrame, start=None, end=None, time_col: str = "detected_at",
                       severities: Sequence[str] | None = None) -> DataFrame:
    """R16 (+R19's severity parameter)."""
    df = _window(issues, time_col, start, end)
    if severities:
        df = df.where(F.col("severity").isin(list(severities)))
    return df.groupBy("severity").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), "severity")


def quality_rate(issues: DataFrame, trades: DataFrame, quotes: DataFrame) -> DataFrame:
    """100 − issues / (trades + quotes) · 100, three places (one row)."""
    from tape.operators.quality import issue_rate
    r = issue_rate(issues, trades, quotes)
    return r.select(F.round(F.lit(100.0) - F.col("issue_pct"), 3).alias("quality_pct"))


def recent_issues(issues: DataFrame, start=None, end=None, symbols=None, k: int = 200,
                  time_col: str = "detected_at") -> DataFrame:
    """Latest ``k`` findings in full."""
    cols = ["detected_at", "source_table", "symbol", "event_time", "issue_type", "severity", "details"]
    rest = [c for c in cols if c != time_col]
    return (_window(issues, time_col, start, end, symbols)
            .select(*cols)
            .orderBy(F.desc(time_col), *rest)
            .limit(k))


def symbol_options(df: DataFrame) -> DataFrame:
    """The distinct sorted symbol list that feeds the symbol parameter."""
    return df.select("symbol").distinct().orderBy("symbol")
