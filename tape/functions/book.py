"""Order-book measures on the level arrays, evaluated on the snapshot row
(no explode, no shuffle).  Level 1 is the best price.

Books have a fixed depth (``BOOK_LEVELS``), so each measure is unrolled into
plain ``element_at`` arithmetic, which whole-stage codegen compiles; Spark's
higher-order functions (``aggregate``/``filter``/``zip_with``) are evaluated
interpreted, row by row.  Arrays longer than the unrolled depth take the
higher-order form inside the same CASE, so any length is handled exactly.
Element order and NULL propagation are the same in both forms.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tape.functions.prices import round_exact
from tape.functions.time import col
from tape.schemas import BOOK_LEVELS


def _n(c) -> str:
    """A column name quoted for SQL text."""
    return "`" + c.replace("`", "``") + "`"


def _unrolled(arrays: list[str], term, zero: str, levels: int, fallback: str) -> Column:
    """Σ over levels of ``term(i)``, left to right from ``zero``; levels past
    the arrays' end add ``zero``.  Built as SQL text: one expression parsed
    on the JVM side instead of thousands of Python-side calls."""
    n = (f"size({_n(arrays[0])})" if len(arrays) == 1
         else "greatest(" + ", ".join(f"size({_n(a)})" for a in arrays) + ")")
    terms = " + ".join(f"(CASE WHEN {n} >= {i} THEN {term(i)} ELSE {zero} END)" for i in range(1, levels + 1))
    return F.expr(f"CASE WHEN {n} <= {levels} THEN {zero} + {terms} ELSE {fallback} END")


def _at(a: str, i: int) -> str:
    return f"try_element_at({_n(a)}, {i})"


def best(prices) -> Column:
    """Best bid / best ask = element 1; NULL on an empty side."""
    return F.try_element_at(col(prices), F.lit(1))


def array_sum(a: str, levels: int = BOOK_LEVELS) -> Column:
    zero = "CAST(0 AS BIGINT)"
    return _unrolled([a], lambda i: _at(a, i), zero, levels,
                     f"aggregate({_n(a)}, {zero}, (acc, x) -> acc + x)")


def dot(prices: str, sizes: str, levels: int = BOOK_LEVELS) -> Column:
    """Σ price·size over levels."""
    zero = "CAST(0 AS DOUBLE)"
    hof = f"aggregate(zip_with({_n(prices)}, {_n(sizes)}, (p, s) -> p * s), {zero}, (acc, v) -> acc + v)"
    return _unrolled([prices, sizes], lambda i: f"{_at(prices, i)} * {_at(sizes, i)}", zero, levels, hof)


def snapshot_mid(bid_prices="bid_prices", ask_prices="ask_prices", digits: int | None = 4) -> Column:
    """(best bid + best ask) / 2."""
    m = (best(bid_prices) + best(ask_prices)) / F.lit(2.0)
    return round_exact(m, digits) if digits is not None else m


def weighted_mid(bid_prices="bid_prices", bid_sizes="bid_sizes", ask_prices="ask_prices",
                 ask_sizes="ask_sizes", digits: int | None = 4) -> Column:
    """Σ(p·s)/Σs over both sides; the mid when the book is empty."""
    num = dot(bid_prices, bid_sizes) + dot(ask_prices, ask_sizes)
    den = array_sum(bid_sizes) + array_sum(ask_sizes)
    w = F.try_divide(num, den)
    if digits is not None:
        w = round_exact(w, digits)
    return F.coalesce(w, snapshot_mid(bid_prices, ask_prices, digits))


def imbalance(bid_sizes="bid_sizes", ask_sizes="ask_sizes", digits: int | None = 4) -> Column:
    """(Σbid − Σask)/(Σbid + Σask) in [−1, 1]; 0 when both are empty."""
    b, a = array_sum(bid_sizes), array_sum(ask_sizes)
    v = F.try_divide((b - a).cast("double"), (b + a).cast("double"))
    if digits is not None:
        v = round_exact(v, digits)
    return F.coalesce(v, F.lit(0.0))


def depth_within(prices: str, sizes: str, mid_col: str, bps: float, side: str,
                 levels: int = BOOK_LEVELS) -> Column:
    """Σ size of the levels inside the bps band around mid (H15 on arrays)."""
    factor = 1.0 - bps / 10000.0 if side == "bid" else 1.0 + bps / 10000.0
    lim = f"({_n(mid_col)} * {factor!r}D)"
    op = ">=" if side == "bid" else "<="
    zero = "CAST(0 AS BIGINT)"
    hof = (f"aggregate(filter(arrays_zip({_n(prices)}, {_n(sizes)}), z -> z.{_n(prices)} {op} {lim}), "
           f"{zero}, (acc, z) -> acc + z.{_n(sizes)})")
    return _unrolled([prices, sizes],
                     lambda i: f"CASE WHEN {_at(prices, i)} {op} {lim} THEN {_at(sizes, i)} ELSE {zero} END",
                     zero, levels, hof)


def any_level_at_most(prices: str, limit: float = 0.0, levels: int = BOOK_LEVELS) -> Column:
    """Some level has price ≤ ``limit`` (a truncated book): an OR over the
    levels, with the same three-valued logic as ``exists``."""
    n = f"size({_n(prices)})"
    terms = " OR ".join(f"(CASE WHEN {n} >= {i} THEN {_at(prices, i)} <= {limit!r}D ELSE false END)"
                        for i in range(1, levels + 1))
    return F.expr(f"CASE WHEN {n} <= {levels} THEN ({terms}) "
                  f"ELSE exists({_n(prices)}, p -> p <= {limit!r}D) END")


def levels(side: str, prices, sizes) -> Column:
    """array<struct<side, level, price, size>> for one side, level 1-based."""
    return F.transform(F.arrays_zip(col(prices).alias("price"), col(sizes).alias("size")),
                       lambda x, i: F.struct(F.lit(side).alias("side"), (i + 1).alias("level"),
                                             x["price"].alias("price"), x["size"].alias("size")))
