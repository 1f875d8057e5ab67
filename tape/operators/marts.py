"""Marts: daily summary and flag roll-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tape.functions import prices as P
from tape.operators.quantiles import exact_quantiles
from tape.operators.windows import null_safe_join


def daily_trade_stats(stg_trades: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Per symbol-day over all staged trades (flagged ones included)."""
    order = ["timestamp", *tie]
    return (stg_trades.groupBy("symbol", "trade_date")
            .agg(P.first_by_time("trade_price", order, dict(stg_trades.dtypes)).alias("open_price"),
                 P.last_by_time("trade_price", order, dict(stg_trades.dtypes)).alias("close_price"),
                 F.max("trade_price").alias("high_price"),
                 F.min("trade_price").alias("low_price"),
                 F.sum("trade_size").alias("total_volume"),
                 F.sum("trade_notional").alias("total_notional"),
                 P.vwap().alias("day_vwap"),
                 F.count(F.lit(1)).alias("trade_count"),
                 F.count_if("has_quality_issue").alias("trade_quality_issues")))


def daily_quote_stats(stg_quotes: DataFrame, exact: bool = True) -> DataFrame:
    """Per symbol-day spread statistics.

    A symbol-day can be large, so its exact quantiles come from
    ``tape.operators.quantiles`` (no value map per group); ``exact=False``
    takes the mergeable sketch."""
    day = F.col("quote_date").alias("trade_date")
    aggs = [F.avg("spread_bps").alias("avg_spread_bps"), F.count(F.lit(1)).alias("quote_count"),
            F.count_if("has_quality_issue").alias("quote_quality_issues")]
    if exact:
        q = exact_quantiles(stg_quotes.select("symbol", day, "spread_bps"), ["symbol", "trade_date"],
                            "spread_bps", [0.5, 0.95], ["median_spread_bps", "p95_spread_bps"])
        out = null_safe_join(stg_quotes.groupBy("symbol", day).agg(*aggs), q, ["symbol", "trade_date"], "left")
    else:
        out = (stg_quotes.groupBy("symbol", day).agg(*aggs, P.quantiles("spread_bps", [0.5, 0.95], False).alias("_q"))
               .withColumns({"median_spread_bps": F.col("_q")[0], "p95_spread_bps": F.col("_q")[1]}))
    return out.select("symbol", "trade_date", "avg_spread_bps", "median_spread_bps", "p95_spread_bps",
                      "quote_count", "quote_quality_issues")


def daily_summary(stg_trades: DataFrame, stg_quotes: DataFrame, tie: Sequence[str] = (),
                  exact: bool = True) -> DataFrame:
    """Q14 ``mart_daily_summary``: trade day ⟕ quote day on (symbol, date).

    Both sides are one row per symbol-day, joined null-safe (AQE broadcasts the
    smaller side when its measured size is under the threshold).  Days without quotes keep their
    trade issue count and get quote_count 0 (S3).
    """
    t = daily_trade_stats(stg_trades, tie)
    q = daily_quote_stats(stg_quotes, exact)
    j = null_safe_join(t, q, ["symbol", "trade_date"], "left")
    return j.select(
        "symbol", "trade_date", "open_price", "high_price", "low_price", "close_price",
        "total_volume", "total_notional", "day_vwap", "trade_count",
        "avg_spread_bps", "median_spread_bps", "p95_spread_bps",
        F.coalesce("quote_count", F.lit(0).cast("long")).alias("quote_count"),
        (F.col("trade_quality_issues") + F.coalesce("quote_quality_issues", F.lit(0).cast("long")))
        .alias("total_quality_issues"),
        P.pct_return("open_price", "close_price").alias("daily_return_pct"))


def data_quality_summary(stg_trades: DataFrame, stg_quotes: DataFrame) -> DataFrame:
    """Q13 ``mart_data_quality_summary``: flag counts per day, symbol, flag, source."""
    def counts(df, date_col, source):
        return (df.where(F.col("has_quality_issue"))
                .groupBy(F.col(date_col).alias("issue_date"), "symbol",
                         F.col("data_quality_flag").alias("issue_type"))
                .agg(F.count(F.lit(1)).alias("issue_count"))
                .select("issue_date", "symbol", "issue_type", F.lit(source).alias("source_table"),
                        "issue_count"))
    return counts(stg_trades, "trade_date", "trades").unionByName(counts(stg_quotes, "quote_date", "quotes"))
