"""Structured Streaming versions of the tick operators.

The batch staging functions are reused unchanged on streaming frames (they
are narrow).  Event time must be ``timestamp`` (``timestamp_ntz`` is rejected
as event time), so ``event_time`` casts it.  Watermarks bound the state.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tape.functions import prices as P
from tape.operators import quality
from tape.sources import io


def event_time(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def vwap_bars(stg_trades: DataFrame, watermark: str = "10 minutes", width: str = "1 minute",
              tie: Sequence[str] = ()) -> DataFrame:
    """Minute OHLCV+VWAP bars, emitted once a window closes (append mode)."""
    order = ["timestamp", *tie]
    return (stg_trades.where(~F.col("has_quality_issue"))
            .withWatermark("timestamp", watermark)
            .groupBy("symbol", F.window("timestamp", width), "trade_date")
            .agg(P.vwap().alias("vwap"),
                 F.sum("trade_size").alias("total_volume"),
                 F.sum("trade_notional").alias("total_notional"),
                 F.count(F.lit(1)).alias("trade_count"),
                 F.min("trade_price").alias("low"),
                 F.max("trade_price").alias("high"),
                 P.first_by_time("trade_price", order, dict(stg_trades.dtypes)).alias("open"),
                 P.last_by_time("trade_price", order, dict(stg_trades.dtypes)).alias("close"))
            .select("symbol", F.col("window.start").alias("minute_bucket"), "trade_date", "vwap",
                    "total_volume", "total_notional", "trade_count", "low", "high", "open", "close"))


def volume_profile(stg_trades: DataFrame, watermark: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """The 5-minute volume profile on a stream (append mode)."""
    return (stg_trades.where(~F.col("has_quality_issue"))
            .withWatermark("timestamp", watermark)
            .groupBy("symbol", "trade_date", F.window("timestamp", width))
            .agg(F.sum("trade_size").alias("bucket_volume"),
                 F.sum("trade_notional").alias("bucket_notional"),
                 F.count(F.lit(1)).alias("bucket_trade_count"),
                 P.vwap().alias("bucket_vwap"),
                 F.min("trade_price").alias("bucket_low"),
                 F.max("trade_price").alias("bucket_high"))
            .select("symbol", "trade_date", F.col("window.start").alias("bucket_start"), "bucket_volume",
                    "bucket_notional", "bucket_trade_count", "bucket_vwap", "bucket_low", "bucket_high"))


def drop_repeated_ticks(ticks: DataFrame, keys: Sequence[str], watermark: str = "10 minutes",
                        ts: str = "timestamp") -> DataFrame:
    """A tick delivered twice (a re-sent file, a replayed feed) is kept
    once; state per key lives until the watermark passes it."""
    return ticks.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))


STALE_SCHEMA = ("source_table string, symbol string, event_time timestamp, issue_type string, "
                "severity string, details string, gap_us long")
STALE_STATE = "last_us long, pend_us array<long>, pend_tie array<long>"


def _stale_fn(gap_us: int, tie: str | None):
    """Event-time stale check for one symbol.

    State: the last finalised tick (µs) and the ticks not yet final.  A tick
    is final once the watermark has passed it: no earlier tick can still
    arrive, so gaps are computed in (time, tie) order exactly as the batch
    ``lag``.  Ticks older than the last finalised one are late and dropped.
    The event-time timeout is the earliest pending tick, so a symbol that goes
    quiet is still finalised when the watermark moves on."""
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            last, p_us, p_tie = state.get
            pend = pd.DataFrame({"_us": list(p_us or []), "_tie": list(p_tie or [])}, dtype="int64")
        else:
            last, pend = None, pd.DataFrame({"_us": [], "_tie": []}, dtype="int64")
        for pdf in pdfs:
            if len(pdf):
                us = pdf["timestamp"].astype("datetime64[us]").astype("int64")
                t = pdf[tie].astype("int64") if tie else pd.Series(0, index=pdf.index, dtype="int64")
                pend = pd.concat([pend, pd.DataFrame({"_us": us.values, "_tie": t.values})], ignore_index=True)
        if last is not None:
            pend = pend[pend["_us"] >= last]
        wm_us = state.getCurrentWatermarkMs() * 1000
        pend = pend.sort_values(["_us", "_tie"], kind="mergesort")
        done, pend = pend[pend["_us"] <= wm_us], pend[pend["_us"] > wm_us]
        prev = done["_us"].shift(1)
        if last is not None and len(done):
            prev.iloc[0] = last
        gap = done["_us"] - prev
        sel = gap > gap_us
        g = gap[sel].astype("int64")
        cs = (g + 5000) // 10000
        out = pd.DataFrame({
            "source_table": "quotes", "symbol": key[0],
            "event_time": pd.to_datetime(done.loc[sel, "_us"], unit="us"),
            "issue_type": "STALE_QUOTE", "severity": "WARNING",
            "details": "gap_seconds=" + (cs // 100).astype(str) + "." + (cs % 100).astype(str).str.zfill(2),
            "gap_us": g})
        if len(done):
            last = int(done["_us"].iloc[-1])
        state.update((last, pend["_us"].tolist(), pend["_tie"].tolist()))
        if len(pend):
            state.setTimeoutTimestamp(int(pend["_us"].min()) // 1000)
        yield out
    return fn


def stale_quotes(quotes: DataFrame, gap_seconds: float = 5.0, hours: tuple[int, int] = (14, 21),
                 tie: str | None = None, watermark: str = "10 minutes") -> DataFrame:
    """Stale-quote gaps on a stream with per-symbol state (``lag`` is not
    allowed on streams).  Out-of-order ticks within ``watermark`` are put in
    order before gaps are taken; ticks are reported once the watermark passes
    them.  ``tie`` is one integral column that orders equal timestamps."""
    from tape.functions.time import hour_in
    cols = ["symbol", "timestamp"] + ([tie] if tie else [])
    q = quotes.where(hour_in("timestamp", *hours)).select(*cols).withWatermark("timestamp", watermark)
    return q.groupBy("symbol").applyInPandasWithState(
        _stale_fn(int(round(gap_seconds * 1_000_000)), tie), STALE_SCHEMA, STALE_STATE,
        "append", GroupStateTimeout.EventTimeTimeout)


def checks_to_log(log_path: str, as_of=None, table: str = "quotes"):
    """T4: a ``foreachBatch`` function that runs the row-wise checks (crossed
    and zero-size quotes, or zero-size trades) on each micro-batch and appends
    only findings not yet in the log (anti-join on the issue key); a finding
    that occurs twice in one batch is written once.  The log is partitioned by
    event day and is joined with the days of the batch first: Spark prunes the
    partitions by them as it runs (the days alone are broadcast), so the cost of a
    batch does not grow with the log, and nothing of it reaches the driver."""
    checks = {"quotes": quality.quote_row_checks, "trades": quality.zero_size_trades}[table]

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            found = (checks(batch, as_of).dropDuplicates(quality.ISSUE_KEY)
                     .withColumn("event_date", F.to_date("event_time")))
            if found.isEmpty():
                return
            if io.exists(spark, log_path):
                days = found.select("event_date").distinct()
                log = spark.read.schema(found.schema).parquet(log_path).join(F.broadcast(days), "event_date", "left_semi")
                found = found.join(log.select("event_date", *quality.ISSUE_KEY),
                                   ["event_date", *quality.ISSUE_KEY], "left_anti")
            found.write.mode("append").partitionBy("event_date").parquet(log_path)
        finally:
            batch.unpersist()
    return run
