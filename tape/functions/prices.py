"""Price arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tape.functions.time import col


def notional(price="trade_price", size="trade_size") -> Column:
    """B2: price × size."""
    return col(price) * col(size)


def quality_issue(flag="data_quality_flag") -> Column:
    """A row is flagged when its flag is not 'OK'."""
    return col(flag) != F.lit("OK")


def spread(bid="bid_price", ask="ask_price") -> Column:
    return col(ask) - col(bid)


def mid(bid="bid_price", ask="ask_price") -> Column:
    return (col(bid) + col(ask)) / F.lit(2.0)


def spread_bps(bid="bid_price", ask="ask_price") -> Column:
    """(ask-bid)/mid·10⁴; NULL when bid ≤ 0; negative when crossed."""
    return F.when(col(bid) > 0, (col(ask) - col(bid)) / mid(bid, ask) * F.lit(10000.0))


def safe_div(num, den) -> Column:
    """X / 0 → NULL (ANSI mode would raise)."""
    return F.try_divide(col(num), col(den))


def vwap(notional_col="trade_notional", size_col="trade_size") -> Column:
    """D1 as an aggregate expression: Σ notional / Σ size."""
    return safe_div(F.sum(col(notional_col)), F.sum(col(size_col)))


def round_exact(x, digits: int) -> Column:
    """``x`` rounded half up to ``digits`` places, after six places more: what two
    orders of summing differ in (the last bits of a double) is gone before the half
    is looked at.  Spark rounds a double by its shortest decimal text, so the second
    rounding sees an exact half as one.  ``x`` appears once: book measures are long
    expressions that the optimizer copies."""
    return F.round(F.round(col(x), digits + 6), digits)


def pct_return(open_col, close_col) -> Column:
    """(close − open) / open · 100."""
    return safe_div(col(close_col) - col(open_col), col(open_col)) * F.lit(100.0)


def pct_deviation(a, b) -> Column:
    """|a − b| / b · 100."""
    return safe_div(F.abs(col(a) - col(b)), col(b)) * F.lit(100.0)


def in_bps_band(price, mid_col, bps: float, side: str) -> Column:
    """Bid at or above mid·(1−b/10⁴); ask at or below mid·(1+b/10⁴)."""
    if side == "bid":
        return col(price) >= col(mid_col) * F.lit(1.0 - bps / 10000.0)
    return col(price) <= col(mid_col) * F.lit(1.0 + bps / 10000.0)


def order_key(order: list, dtypes: dict | None = None) -> Column:
    """A single ordering key for (timestamp[, tie]).

    A struct key forces sort-based aggregation (struct buffers are not
    updatable in place), so when the order is a timestamp and at most one
    integral tie column it is packed into ``decimal(38,0)``:
    epoch-µs · 10²⁰ + tie — order preserving for any 64-bit tie, and hash
    aggregatable.  Other shapes keep the struct."""
    from tape.functions.time import epoch_micros
    integral = ("bigint", "int", "smallint", "tinyint")
    if len(order) == 1:
        return col(order[0])
    if len(order) == 2 and dtypes is not None and dtypes.get(order[1]) in integral:
        from decimal import Decimal

        def first(c, least):   # NULL sorts before every value
            return F.coalesce(c.cast("decimal(38,0)"), F.lit(Decimal(least)).cast("decimal(38,0)"))
        us = first(epoch_micros(order[0]), -10 ** 17)
        return us * F.lit(Decimal(10 ** 20)).cast("decimal(38,0)") + first(col(order[1]), -10 ** 19)
    return F.struct(*[col(c) for c in order])


def first_by_time(value, order: list, dtypes: dict | None = None) -> Column:
    """D2 open: value at the earliest (timestamp, tie key...)."""
    return F.min_by(col(value), order_key(order, dtypes))


def last_by_time(value, order: list, dtypes: dict | None = None) -> Column:
    """D2 close: value at the latest (timestamp, tie key...)."""
    return F.max_by(col(value), order_key(order, dtypes))


def quantiles(c, qs: list[float], exact: bool = True, accuracy: int = 10000) -> Column:
    """Several quantiles of one column from a single aggregate buffer (an array)."""
    arr = F.array(*[F.lit(float(q)) for q in qs])
    if exact:
        return F.percentile(col(c), arr)
    return F.percentile_approx(col(c), arr, F.lit(accuracy)).cast("array<double>")
