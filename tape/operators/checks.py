"""Table checks (Q7–Q11).  Each returns its failing rows; empty = pass.

``not_null`` evaluates every declared column in one aggregate pass.  ``Watch``
counts the failing rows of a table while some other job reads or writes it, so that
the checks cost no pass of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tape.functions import prices as P
from tape.functions.time import ts_literal

# Columns declared not-null per model (the source system's column contracts).
NOT_NULL = {
    "trades": ["symbol", "timestamp", "trade_price", "trade_size"],
    "quotes": ["symbol", "timestamp", "bid_price", "ask_price"],
    "order_book_snapshots": ["symbol", "timestamp", "bid_prices", "ask_prices", "mid_price"],
    "stg_trades": ["symbol", "timestamp", "trade_price", "trade_size", "data_quality_flag"],
    "stg_quotes": ["symbol", "timestamp", "spread_bps"],
    "stg_order_book": ["symbol", "side", "level", "price", "size"],
    "int_vwap": ["vwap", "total_volume"],
    "int_spread_analytics": ["avg_spread_bps"],
    "int_order_book_depth": ["avg_book_imbalance"],
    "mart_daily_summary": ["symbol", "trade_date", "open_price", "high_price", "low_price",
                           "close_price", "total_volume", "day_vwap"],
    "mart_data_quality_summary": ["issue_date", "symbol", "issue_type", "source_table", "issue_count"],
}


def not_null(df: DataFrame, cols: Sequence[str], model: str = "") -> DataFrame:
    """Q7: one row per column that has NULLs: (model, column_name, null_rows)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in cols])))
    return (stacked.where(F.col("null_rows") > 0)
            .select(F.lit(model).alias("model"), "column_name", "null_rows"))


def accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Q8: values outside the domain with their row counts."""
    return (df.where(~F.col(col).isin(list(values)))
            .groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def duplicates(df: DataFrame, keys: Sequence[str] = ("symbol", "timestamp")) -> DataFrame:
    """Q9: key values that occur more than once."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))


def full_row_duplicates(df: DataFrame) -> DataFrame:
    """Q9 variant (S6): rows repeated in every column — a real double load."""
    return duplicates(df, df.columns)


def future_rows(df: DataFrame, as_of=None, cols: Sequence[str] = ("symbol", "timestamp")) -> DataFrame:
    """Q10: rows stamped after ``as_of`` (default: now)."""
    dtype = df.schema["timestamp"].dataType
    limit = F.current_timestamp().cast(dtype) if as_of is None else ts_literal(as_of, dtype.simpleString())
    return df.where(F.col("timestamp") > limit).select(*cols)


def vwap_out_of_range(mart: DataFrame, pct: float = 5.0) -> DataFrame:
    """Q11: days whose VWAP is more than ``pct`` % away from the close."""
    dev = P.pct_deviation("day_vwap", "close_price")
    return (mart.select("symbol", "trade_date", "day_vwap", "close_price", dev.alias("deviation_pct"))
            .where(F.abs(F.col("day_vwap") - F.col("close_price")) / F.col("close_price") > F.lit(pct / 100.0)))


class Watch:
    """Q7, Q8, Q10, Q11 during the pass that reads or writes a table.

    ``add`` hangs the counts on a DataFrame (``DataFrame.observe``); once an action
    has run over it, ``failing`` gives them.  A DataFrame must be run once: what
    sits below a range exchange would be counted by its sampling too, so writers
    call ``add`` behind their exchange.  Where Spark runs a task again after a lost
    executor, a count may come out too high, never too low.
    """

    def __init__(self, as_of=None):
        self.as_of = as_of
        self.seen: list[tuple[Observation, list[tuple[str, str]]]] = []

    def add(self, name: str, df: DataFrame, domains: dict[str, Sequence[str]] | None = None, future: bool = False,
            vwap_pct: float | None = None) -> DataFrame:
        """``df``, observed: the declared not-null columns of model ``name``, the
        ``domains`` (column → values), rows in the ``future``, days whose VWAP is
        more than ``vwap_pct`` % off the close."""
        tests: list[tuple[str, str, Column]] = [
            (f"not_null:{name}", c, F.col(c).isNull()) for c in NOT_NULL.get(name, [])]
        tests += [(f"accepted_values:{name}.{c}", "", ~F.col(c).isin(list(v))) for c, v in (domains or {}).items()]
        if future:
            dtype = df.schema["timestamp"].dataType
            limit = F.current_timestamp().cast(dtype) if self.as_of is None else ts_literal(self.as_of, dtype.simpleString())
            tests.append((f"no_future:{name}", "", F.col("timestamp") > limit))
        if vwap_pct is not None:
            tests.append(("vwap_within_range", "", F.abs(F.col("day_vwap") - F.col("close_price")) / F.col("close_price") > F.lit(vwap_pct / 100.0)))
        if not tests:
            return df
        counts = Observation()
        self.seen.append((counts, [(test, detail) for test, detail, _ in tests]))
        return df.observe(counts, *[F.count_if(broken).alias(f"c{i}") for i, (_, _, broken) in enumerate(tests)])

    def failing(self) -> list[tuple[str, str, int]]:
        """(test, detail, failing rows) of all tests, of the passes that ran."""
        return [(test, detail, counts.get[f"c{i}"]) for counts, tests in self.seen for i, (test, detail) in enumerate(tests)]

    def result(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.failing(), "test string, detail string, failing_rows long")
