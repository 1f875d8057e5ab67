"""Staging models: light cleaning of the raw tick tables.

All are narrow projections/filters: they fuse into the scan's codegen stage
and the ``price > 0`` predicates are pushed into the Parquet reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tape.functions import book as B
from tape.functions import prices as P
from tape.functions.time import to_date


def stg_trades(trades: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """B1: drop price ≤ 0 (zero-size rows stay), add date, notional, issue flag.
    ``keep`` carries extra columns (tie keys) through."""
    return (trades.where(F.col("trade_price") > 0)
            .select("symbol", "timestamp",
                    to_date("timestamp").alias("trade_date"),
                    "trade_price", "trade_size",
                    P.notional().alias("trade_notional"),
                    "exchange", "trade_condition", "data_quality_flag",
                    P.quality_issue().alias("has_quality_issue"),
                    *keep))


def stg_quotes(quotes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop quotes with a non-positive side, add spread, bps, mid."""
    return (quotes.where((F.col("bid_price") > 0) & (F.col("ask_price") > 0))
            .select("symbol", "timestamp",
                    to_date("timestamp").alias("quote_date"),
                    "bid_price", "ask_price", "bid_size", "ask_size",
                    P.spread().alias("spread"),
                    P.spread_bps().alias("spread_bps"),
                    P.mid().alias("mid_price"),
                    "exchange", "data_quality_flag",
                    P.quality_issue().alias("has_quality_issue"),
                    *keep))


def enrich_book(snapshots: DataFrame, digits: int | None = 4) -> DataFrame:
    """Mid, size-weighted mid and imbalance computed from the arrays."""
    return snapshots.withColumns({
        "mid_price": B.snapshot_mid(digits=digits),
        "weighted_mid": B.weighted_mid(digits=digits),
        "book_imbalance": B.imbalance(digits=digits),
    })


def book_snapshots(snapshots: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The snapshot CTE: date and issue flag next to the arrays."""
    return snapshots.select(
        "symbol", "timestamp", to_date("timestamp").alias("snap_date"),
        "bid_prices", "bid_sizes", "ask_prices", "ask_sizes",
        "mid_price", "weighted_mid", "book_imbalance", "data_quality_flag",
        P.quality_issue().alias("has_quality_issue"), *keep)


def stg_order_book(snapshots: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """C4/G1: one row per (snapshot, side, level) from a single scan — both
    sides are concatenated into one array of structs and inlined, instead of
    scanning the table twice and unioning."""
    s = book_snapshots(snapshots, keep)
    lv = F.concat(B.levels("bid", "bid_prices", "bid_sizes"),
                  B.levels("ask", "ask_prices", "ask_sizes"))
    return s.select("symbol", "timestamp", "snap_date", F.inline(lv),
                    "mid_price", "weighted_mid", "book_imbalance", "has_quality_issue", *keep)


def trading_days(ticks: DataFrame, ts: str = "timestamp") -> DataFrame:
    """The weekday calendar spanning the data, with session bounds.
    One global min/max aggregate, then a generated sequence (tiny)."""
    from tape.functions.time import session_bounds, weekdays
    span = ticks.agg(F.min(to_date(ts)).alias("_a"), F.max(to_date(ts)).alias("_b"))
    days = span.select(F.explode(weekdays("_a", "_b")).alias("trade_date"))
    o, c = session_bounds("trade_date")
    return days.select("trade_date", o.alias("session_open"), c.alias("session_close"))
