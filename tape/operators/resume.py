"""Scans that go on where the last one ended.

The window checks look back over a bounded past: the stale check at the last
quote of the symbol, the outlier check at its last 999 trades.  Each run writes
that past as two small tables, so that the next one reads only its own slice of
ticks (a day, an hour) and no history.  Scanning slice by slice finds what one
scan of all ticks finds.

    base/log                 the issue log (partitioned by day)
    base/state/run=<n>/...   what run <n> leaves: ``trades`` and ``quotes``

Slices come in time order.  A run that is repeated starts from the state of the
run before and adds nothing to the log that is there; a run that failed is
repeated the same way.  Ticks that come late, earlier than the state's, are judged
in their place in time, but what is in the log of later ticks stays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tape.functions.time import hour_in
from tape.operators import quality
from tape.operators.windows import total_order
from tape.sources import io

#: Trades that a frame of 1000 needs of the past.
PAST_TRADES = 999


def last_trades(trades: DataFrame, seen: DataFrame | None, tie: Sequence[str] = (), keep: int = PAST_TRADES) -> DataFrame:
    """The last ``keep`` trades of every symbol.  Each task cuts its own rows
    before the exchange (a limit inside the window's groups)."""
    t = trades.select("symbol", "timestamp", "trade_price", *tie)
    t = t if seen is None else t.unionByName(seen.select(*t.columns))
    order = [F.desc(c) for c in total_order(t, ["symbol"], ["timestamp", *tie])]
    return (t.withColumn("_back", F.row_number().over(Window.partitionBy("symbol").orderBy(*order)))
            .where(F.col("_back") <= keep).drop("_back"))


def last_quotes(quotes: DataFrame, seen: DataFrame | None, tie: Sequence[str] = (), hours: tuple[int, int] = (14, 21)) -> DataFrame:
    """The last quote of every symbol inside the checked hours."""
    q = quotes.where(hour_in("timestamp", *hours)).select("symbol", "timestamp", *tie)
    q = q if seen is None else q.unionByName(seen.select(*q.columns))
    last = F.max(F.struct("timestamp", *tie)).alias("_m")
    return q.groupBy("symbol").agg(last).select("symbol", "_m.*")


def state(spark: SparkSession, base: str, run: int) -> tuple[DataFrame | None, DataFrame | None]:
    """(trades, quotes) that the runs up to ``run`` have left."""
    if run < 1:
        return None, None
    return tuple(spark.read.parquet(f"{base}/state/run={run}/{name}") for name in ("trades", "quotes"))


def scan_slice(spark: SparkSession, trades: DataFrame, quotes: DataFrame, base: str, run: int, as_of=None,
               tie: Sequence[str] = (), event_days: tuple | None = None, block_rows: int = 100_000) -> None:
    """Run number ``run`` (from 1) over one slice: append its findings to the log
    and write the state.  The state comes last, so that a run without one is
    repeated."""
    seen_trades, seen_quotes = state(spark, base, run - 1)
    kind = quotes.schema["timestamp"].dataType
    if run == 1 and not io.exists(spark, f"{base}/log"):
        io.reset_issues(spark, f"{base}/log", kind)
    log = spark.read.schema(io.issue_log_schema(kind)).parquet(f"{base}/log")
    found = quality.scan(trades, quotes, log=log, as_of=as_of, tie=tie, block_rows=block_rows, event_days=event_days,
                         seen_trades=seen_trades, seen_quotes=seen_quotes)
    io.append_issues(found, f"{base}/log")
    for name, left in (("trades", last_trades(trades, seen_trades, tie)), ("quotes", last_quotes(quotes, seen_quotes, tie))):
        left.write.mode("overwrite").parquet(f"{base}/state/run={run}/{name}")


def findings(spark: SparkSession, base: str, kind) -> DataFrame:
    """The issue log below ``base``."""
    return spark.read.schema(io.issue_log_schema(kind)).parquet(f"{base}/log")
