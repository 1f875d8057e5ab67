"""Tick views derived from the shared test tables.

The test set has no market data, so trades, quotes and book snapshots are
column formulas over ``events`` (and trades also over ``lineitem``).  Each
view is a narrow projection of one scan: no shuffle, filters and column
pruning reach the Parquet reader.  ``tick_id`` / the lineitem key columns
are the tie keys that make time ordering total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tape.schemas import BOOK_LEVELS, EXCHANGES, TRADE_CONDITIONS

EVENTS_TIE = ["tick_id"]
LINEITEM_TIE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


_SCHEMAS: dict[tuple, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table.  Its Parquet schema is inferred once per file
    (keyed by path, size and modification time) and passed to later reads,
    which skips the footer-inference job on every query."""
    import os
    path = f"{sf_dir}/{name}.parquet"
    try:
        st = os.stat(path)
        key = (path, st.st_size, st.st_mtime_ns)
    except OSError:       # not a local path: let Spark infer every time
        return spark.read.parquet(path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def _pick(values: list[str], idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int") + 1)


def _event_base(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.col("event_type"), F.lit("_"), (F.col("user_id") % 5).cast("string")).alias("symbol"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("tick_id"),
        F.col("value"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


def trades_from_events(events: DataFrame) -> DataFrame:
    b = _event_base(events)
    flag = (F.when(F.col("k") == 0, "MISSING_FIELD")
             .when(F.col("value") > 250, "PRICE_OUTLIER")
             .otherwise("OK"))
    return b.select(
        "symbol", "timestamp",
        F.col("value").alias("trade_price"),
        F.col("k").alias("trade_size"),
        _pick(EXCHANGES, F.col("tick_id") % 6).alias("exchange"),
        _pick(TRADE_CONDITIONS, F.col("tick_id") % 5).alias("trade_condition"),
        flag.alias("data_quality_flag"),
        "tick_id",
    )


def quotes_from_events(events: DataFrame) -> DataFrame:
    b = _event_base(events)
    crossed = (F.col("tick_id") % 1000) == 7
    mid0 = F.lit(100.0) + F.col("value") / F.lit(10.0)
    half = (F.col("k") + 1) / F.lit(1000.0)
    lo, hi = mid0 - half, mid0 + half
    bid_size = F.lit(100) * ((F.lit(7) * F.col("tick_id")) % 97)
    flag = (F.when(crossed, "CROSSED_SPREAD")
             .when(F.col("tick_id") % 500 == 3, "STALE")
             .when(bid_size == 0, "MISSING_FIELD")
             .otherwise("OK"))
    return b.select(
        "symbol", "timestamp",
        F.when(crossed, hi).otherwise(lo).alias("bid_price"),
        F.when(crossed, lo).otherwise(hi).alias("ask_price"),
        bid_size.alias("bid_size"),
        (F.lit(100) * (F.lit(1) + F.col("tick_id") % 5)).alias("ask_size"),
        _pick(EXCHANGES, F.col("tick_id") % 6).alias("exchange"),
        flag.alias("data_quality_flag"),
        "tick_id",
    )


def book_from_events(events: DataFrame) -> DataFrame:
    """Raw snapshots (arrays only); mid / weighted mid / imbalance are added
    by ``tape.operators.staging.enrich_book`` (C6–C8).  The per-level arrays
    are SQL text over the best prices (one expression per array)."""
    b = _event_base(events)
    tid = F.col("tick_id")
    crossed = (tid % 700) == 5
    missing = ((tid % 400) == 11) & ~crossed
    mid0 = F.lit(100.0) + F.col("value") / F.lit(10.0)
    half = (F.col("k") + 1) / F.lit(1000.0)
    b = b.select("symbol", "timestamp", "tick_id",
                 F.when(crossed, mid0 + half + F.lit(0.01)).otherwise(mid0 - half).alias("_bid1"),
                 F.when(crossed, mid0 - half - F.lit(0.01)).otherwise(mid0 + half).alias("_ask1"),
                 missing.alias("_missing"),
                 F.when(crossed, "CROSSED_BOOK").when(missing, "MISSING_LEVELS").otherwise("OK")
                 .alias("data_quality_flag"))

    def per_level(fn, zero):
        return F.expr("array(" + ", ".join(
            f"CASE WHEN _missing AND {str(i > 5).lower()} THEN {zero} ELSE {fn(i)} END"
            for i in range(1, BOOK_LEVELS + 1)) + ")")

    return b.select(
        "symbol", "timestamp",
        per_level(lambda i: f"_bid1 - ({i} - 1) * 0.02D", "0.0D").alias("bid_prices"),
        per_level(lambda i: f"100 * (1 + (tick_id * {i}) % 7)", "CAST(0 AS BIGINT)").alias("bid_sizes"),
        per_level(lambda i: f"_ask1 + ({i} - 1) * 0.02D", "0.0D").alias("ask_prices"),
        per_level(lambda i: f"100 * (1 + (tick_id * {i}) % 5)", "CAST(0 AS BIGINT)").alias("ask_sizes"),
        "data_quality_flag",
        "tick_id",
    )


def trades_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Larger trade tape with genuine (symbol, timestamp) repeats."""
    offs = (F.lit(17) * F.col("l_orderkey") + F.lit(31) * F.col("l_partkey")
            + F.lit(7) * F.col("l_linenumber")) % 23400
    ts = (F.col("l_shipdate")
          + F.make_dt_interval(F.lit(0), F.lit(14), F.lit(30))
          + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), offs.cast("decimal(18,6)")))
    return lineitem.select(
        F.concat(F.lit("S"), F.lpad((F.col("l_suppkey") % 25).cast("string"), 2, "0")).alias("symbol"),
        ts.alias("timestamp"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("trade_price"),
        F.col("l_quantity").cast("long").alias("trade_size"),
        _pick(EXCHANGES, F.col("l_orderkey") % 6).alias("exchange"),
        _pick(TRADE_CONDITIONS, F.col("l_linenumber") % 5).alias("trade_condition"),
        F.lit("OK").alias("data_quality_flag"),
        *LINEITEM_TIE,
    )


def event_ticks(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    ev = table(spark, sf_dir, "events")
    return {"trades": trades_from_events(ev), "quotes": quotes_from_events(ev),
            "order_book_snapshots": book_from_events(ev)}
