"""Bar models: OHLCV+VWAP, volume profile, spread statistics.

Each is one ``groupBy`` → HashAggregate (partial on the map side, final after
one exchange on the group key).  ``min_by``/``max_by``/``percentile`` use the
object hash aggregate, which falls back to sort when memory runs out.
Groups are bounded by time (one symbol-minute / symbol-5min), so a hot symbol
spreads over many keys and many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tape.functions import prices as P
from tape.functions.time import bucket, ts_type


def vwap_bars(stg_trades: DataFrame, seconds: int = 60, tie: Sequence[str] = (),
              clean_only: bool = True) -> DataFrame:
    """D5 ``int_vwap``: per symbol and minute over unflagged trades."""
    t = stg_trades.where(~F.col("has_quality_issue")) if clean_only else stg_trades
    order = ["timestamp", *tie]
    return (t.groupBy("symbol",
                      bucket("timestamp", seconds, ts_type(stg_trades, "timestamp")).alias("minute_bucket"),
                      "trade_date")
            .agg(P.vwap().alias("vwap"),
                 F.sum("trade_size").alias("total_volume"),
                 F.sum("trade_notional").alias("total_notional"),
                 F.count(F.lit(1)).alias("trade_count"),
                 F.min("trade_price").alias("low"),
                 F.max("trade_price").alias("high"),
                 P.first_by_time("trade_price", order, dict(stg_trades.dtypes)).alias("open"),
                 P.last_by_time("trade_price", order, dict(stg_trades.dtypes)).alias("close")))


def volume_profile(stg_trades: DataFrame, seconds: int = 300) -> DataFrame:
    """D6 ``int_volume_profile``: 5-minute buckets over unflagged trades."""
    return (stg_trades.where(~F.col("has_quality_issue"))
            .groupBy("symbol", "trade_date",
                     bucket("timestamp", seconds, ts_type(stg_trades, "timestamp")).alias("bucket_start"))
            .agg(F.sum("trade_size").alias("bucket_volume"),
                 F.sum("trade_notional").alias("bucket_notional"),
                 F.count(F.lit(1)).alias("bucket_trade_count"),
                 P.vwap().alias("bucket_vwap"),
                 F.min("trade_price").alias("bucket_low"),
                 F.max("trade_price").alias("bucket_high")))


def spread_stats(stg_quotes: DataFrame, seconds: int = 60, exact: bool = True) -> DataFrame:
    """D7 ``int_spread_analytics``: per symbol-minute over all staged quotes
    (flagged ones included, and counted).  Median and p95 share one
    percentile buffer."""
    return (stg_quotes
            .groupBy("symbol",
                     bucket("timestamp", seconds, ts_type(stg_quotes, "timestamp")).alias("minute_bucket"),
                     "quote_date")
            .agg(F.avg("spread_bps").alias("avg_spread_bps"),
                 P.quantiles("spread_bps", [0.5, 0.95], exact).alias("_q"),
                 F.min("spread_bps").alias("min_spread_bps"),
                 F.max("spread_bps").alias("max_spread_bps"),
                 F.avg(F.col("bid_size") + F.col("ask_size")).alias("avg_depth"),
                 F.count(F.lit(1)).alias("quote_count"),
                 F.count_if("has_quality_issue").alias("quality_issue_count"))
            .select("symbol", "minute_bucket", "quote_date", "avg_spread_bps",
                    F.col("_q")[0].alias("median_spread_bps"), F.col("_q")[1].alias("p95_spread_bps"),
                    "min_spread_bps", "max_spread_bps", "avg_depth", "quote_count", "quality_issue_count"))
