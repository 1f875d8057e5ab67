"""Rule-based quality flags (Q12): derive ``data_quality_flag`` from the data
instead of trusting an upstream label.  Pure column expressions (one
``when`` chain per table), evaluated inside the scan's codegen stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tape.functions import book as B
from tape.functions import prices as P


def quote_flag(wide_bps: float | None = None) -> Column:
    """CROSSED_SPREAD (bid > ask) → MISSING_FIELD (a zero or missing size) →
    WIDE_SPREAD (over ``wide_bps``, when given) → OK."""
    miss = ((F.col("bid_size") == 0) | (F.col("ask_size") == 0)
            | F.col("bid_size").isNull() | F.col("ask_size").isNull())
    c = F.when(F.col("bid_price") > F.col("ask_price"), "CROSSED_SPREAD").when(miss, "MISSING_FIELD")
    if wide_bps is not None:
        c = c.when(P.spread_bps() > F.lit(float(wide_bps)), "WIDE_SPREAD")
    return c.otherwise("OK")


def trade_flag(reference_price: str | None = None, outlier_pct: float = 5.0, size_outlier: str | None = None) -> Column:
    """MISSING_FIELD (size 0) → PRICE_OUTLIER (more than ``outlier_pct`` % from
    ``reference_price``, e.g. the prevailing mid from ``asof.prevailing``) →
    SIZE_OUTLIER (where column ``size_outlier`` holds, see ``sizes``) → OK."""
    c = F.when((F.col("trade_size") == 0) | F.col("trade_size").isNull(), "MISSING_FIELD")
    if reference_price is not None:
        c = c.when(P.pct_deviation("trade_price", reference_price) > F.lit(outlier_pct), "PRICE_OUTLIER")
    if size_outlier is not None:
        c = c.when(F.col(size_outlier), "SIZE_OUTLIER")
    return c.otherwise("OK")


def book_flag() -> Column:
    """CROSSED_BOOK (best bid > best ask) → MISSING_LEVELS (a level with price
    0, i.e. a truncated book) → OK."""
    crossed = B.best("bid_prices") > B.best("ask_prices")
    missing = B.any_level_at_most("bid_prices") | B.any_level_at_most("ask_prices")
    return F.when(crossed, "CROSSED_BOOK").when(missing, "MISSING_LEVELS").otherwise("OK")


def flag_quotes(quotes: DataFrame, wide_bps: float | None = None) -> DataFrame:
    return quotes.withColumn("data_quality_flag", quote_flag(wide_bps))


def flag_trades(trades: DataFrame, reference_price: str | None = None, outlier_pct: float = 5.0,
                size_outlier: str | None = None) -> DataFrame:
    return trades.withColumn("data_quality_flag", trade_flag(reference_price, outlier_pct, size_outlier))


def flag_book(snapshots: DataFrame) -> DataFrame:
    return snapshots.withColumn("data_quality_flag", book_flag())
