"""Data-quality findings.

Every check returns rows in the issue-log schema
(detected_at, source_table, symbol, event_time, issue_type, severity, details)
so the scan is one union and one write.  Checks run on the *raw* tables, like
the source system.  ``detected_at`` is the run time passed in (``as_of``) so a
run is reproducible.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tape.functions.prices import round_exact
from tape.functions.time import hour_in, micros_between, to_date, ts_literal
from tape.operators import windows
from tape.schemas import ISSUE_COLUMNS

ISSUE_KEY = ["source_table", "issue_type", "symbol", "event_time"]


def _detected(as_of, dtype: str = "timestamp") -> Column:
    """The run time, in the same timestamp type as the event times (all of a
    log's times are UTC wall clock of one type)."""
    return F.current_timestamp().cast(dtype) if as_of is None else ts_literal(as_of, dtype)


def _ts_type(df: DataFrame) -> str:
    return df.schema["timestamp"].dataType.simpleString()


def _issues(df: DataFrame, source: str, issue: str, severity: str, details: Column, as_of=None,
            extra: Sequence[str] = ()) -> DataFrame:
    return df.select(
        _detected(as_of, _ts_type(df)).alias("detected_at"),
        F.lit(source).alias("source_table"),
        "symbol",
        F.col("timestamp").alias("event_time"),
        F.lit(issue).alias("issue_type"),
        F.lit(severity).alias("severity"),
        details.alias("details"),
        *extra)


def crossed_spreads(quotes: DataFrame, as_of=None) -> DataFrame:
    """Q1: bid > ask on raw quotes → CRITICAL."""
    d = F.format_string("bid=%.4f ask=%.4f spread=%.4f", "bid_price", "ask_price",
                        F.col("bid_price") - F.col("ask_price"))
    return _issues(quotes.where(F.col("bid_price") > F.col("ask_price")),
                   "quotes", "CROSSED_SPREAD", "CRITICAL", d, as_of)


def _gap_text(us) -> Column:
    # seconds to 2 places, half up, from whole microseconds (exact integer math)
    cs = F.floor((us + 5000) / 10000).cast("long")
    return F.concat(F.lit("gap_seconds="), (F.floor(cs / 100)).cast("long").cast("string"), F.lit("."),
                    F.lpad((cs % 100).cast("string"), 2, "0"))


def _with_seen(rows: DataFrame, seen: DataFrame | None) -> DataFrame:
    """``rows`` and those that an earlier scan has judged, told apart by ``_seen``."""
    rows = rows.withColumn("_seen", F.lit(False))
    return rows if seen is None else rows.unionByName(seen.select(*[c for c in rows.columns if c != "_seen"]).withColumn("_seen", F.lit(True)))


def stale_quotes(quotes: DataFrame, gap_seconds: float = 5.0, hours: tuple[int, int] = (14, 21),
                 tie: Sequence[str] = (), reset_daily: bool = False,
                 block_rows: int = 100_000, as_of=None, rank: str = "time",
                 seen: DataFrame | None = None) -> DataFrame:
    """Q2: gap to the previous quote of the symbol > ``gap_seconds`` → WARNING.

    The hour filter runs before the lag (as in the source system).  The first
    quote of a symbol has no predecessor and is never reported (S1); with
    ``reset_daily`` the first quote of each day is not compared with the day
    before (S2).  ``seen`` (symbol, timestamp, tie) are quotes of earlier scans:
    predecessors that are not reported again.
    """
    q = _with_seen(quotes.where(hour_in("timestamp", *hours)).select("symbol", "timestamp", *tie), seen)
    part = ["symbol"]
    if reset_daily:
        q = q.withColumn("_day", to_date("timestamp"))
        part.append("_day")
    q = windows.previous(q, "timestamp", part, ["timestamp", *tie], "_prev", block_rows=block_rows, rank=rank)
    q = q.withColumn("_gap_us", micros_between("_prev", "timestamp"))
    hit = q.where(~F.col("_seen") & (F.col("_gap_us") > F.lit(int(round(gap_seconds * 1_000_000)))))
    return _issues(hit, "quotes", "STALE_QUOTE", "WARNING", _gap_text(F.col("_gap_us")), as_of,
                   extra=["_gap_us"]).withColumnRenamed("_gap_us", "gap_us")


def price_outliers(trades: DataFrame, rows: int = 1000, z_limit: float = 3.0, tie: Sequence[str] = (),
                   block_rows: int = 100_000, as_of=None, rank: str = "time",
                   seen: DataFrame | None = None) -> DataFrame:
    """Q3: |price − rolling mean| / rolling σ > ``z_limit`` over the last
    ``rows`` trades of the symbol (current one included) → CRITICAL.

    σ is the population deviation with the current trade inside the frame,
    so z ≤ √(n−1): nothing fires before the 11th trade of a symbol (S7).
    ``seen`` (symbol, timestamp, trade_price, tie) are trades of earlier scans:
    they are in the frames but are not reported again.
    """
    t = _with_seen(trades.select("symbol", "timestamp", "trade_price", *tie), seen)
    t = windows.rolling_mean_std(t, "trade_price", ["symbol"], ["timestamp", *tie], rows,
                                 block_rows=block_rows, rank=rank)
    m, s = F.col("rolling_mean"), F.col("rolling_std")
    t = t.withColumn("z_score", F.when(s > 0, F.abs(F.col("trade_price") - m) / s).otherwise(F.lit(0.0)))
    hit = t.where(~F.col("_seen") & (F.col("z_score") > z_limit) & (s > 0))
    d = F.format_string("price=%.2f rolling_mean=%.2f rolling_std=%.4f z_score=%.2f",
                        round_exact("trade_price", 2), round_exact("rolling_mean", 2),
                        round_exact("rolling_std", 4), round_exact("z_score", 2))
    return _issues(hit, "trades", "PRICE_OUTLIER", "CRITICAL", d, as_of,
                   extra=["trade_price", "rolling_mean", "rolling_std", "z_score"])


def zero_size_trades(trades: DataFrame, as_of=None) -> DataFrame:
    """Q4: trade_size = 0 → WARNING."""
    return _issues(trades.where(F.col("trade_size") == 0), "trades", "MISSING_FIELD", "WARNING",
                   F.lit("trade_size is 0"), as_of)


def zero_size_quotes(quotes: DataFrame, as_of=None) -> DataFrame:
    """Q5: bid_size = 0 or ask_size = 0 → WARNING (the OR is grouped, S5)."""
    d = F.concat(F.lit("bid_size="), F.col("bid_size").cast("string"),
                 F.lit(" ask_size="), F.col("ask_size").cast("string"))
    return _issues(quotes.where((F.col("bid_size") == 0) | (F.col("ask_size") == 0)),
                   "quotes", "MISSING_FIELD", "WARNING", d, as_of)


def quote_row_checks(quotes: DataFrame, as_of=None) -> DataFrame:
    """Q1 + Q5 in one pass over the quotes: each row yields 0, 1 or 2 findings
    (an array of optional findings, exploded), instead of one scan per check."""
    crossed = F.col("bid_price") > F.col("ask_price")
    zero = (F.col("bid_size") == 0) | (F.col("ask_size") == 0)

    def finding(issue, severity, details):
        return F.struct(F.lit(issue).alias("issue_type"), F.lit(severity).alias("severity"),
                        details.alias("details"))
    c_det = F.format_string("bid=%.4f ask=%.4f spread=%.4f", "bid_price", "ask_price",
                            F.col("bid_price") - F.col("ask_price"))
    z_det = F.concat(F.lit("bid_size="), F.col("bid_size").cast("string"),
                     F.lit(" ask_size="), F.col("ask_size").cast("string"))
    found = F.filter(F.array(F.when(crossed, finding("CROSSED_SPREAD", "CRITICAL", c_det)),
                             F.when(zero, finding("MISSING_FIELD", "WARNING", z_det))),
                     lambda x: x.isNotNull())
    return (quotes.where(crossed | zero)
            .select("symbol", "timestamp", F.explode(found).alias("_f"))
            .select(_detected(as_of, _ts_type(quotes)).alias("detected_at"), F.lit("quotes").alias("source_table"), "symbol",
                    F.col("timestamp").alias("event_time"), "_f.issue_type", "_f.severity", "_f.details"))


def new_findings(findings: DataFrame, log: DataFrame | None, event_days: tuple | None = None) -> DataFrame:
    """Drop findings already in the log (hash anti-join on the issue key;
    ``NOT IN`` would plan as a nested-loop join).  ``event_days`` (first, last)
    of the scanned ticks prunes a log partitioned by ``event_date``."""
    if log is None:
        return findings
    if event_days is not None and "event_date" in log.columns:
        log = log.where(F.col("event_date").between(*[F.lit(d) for d in event_days]))
    return findings.join(log.select(*ISSUE_KEY), ISSUE_KEY, "left_anti")


def scan(trades: DataFrame, quotes: DataFrame, log: DataFrame | None = None, as_of=None,
         tie: Sequence[str] = (), block_rows: int = 100_000, event_days: tuple | None = None,
         seen_trades: DataFrame | None = None, seen_quotes: DataFrame | None = None) -> DataFrame:
    """Q6: all checks as one frame in the log schema, minus what ``log`` holds
    (of the ``event_days``, where the ticks' days are known).  ``seen_trades`` and
    ``seen_quotes`` are what the windows need of earlier scans (``resume``)."""
    as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    parts = [
        quote_row_checks(quotes, as_of),
        stale_quotes(quotes, tie=tie, block_rows=block_rows, as_of=as_of, seen=seen_quotes),
        price_outliers(trades, tie=tie, block_rows=block_rows, as_of=as_of, seen=seen_trades),
        zero_size_trades(trades, as_of),
    ]
    out = parts[0].select(*ISSUE_COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*ISSUE_COLUMNS))
    return new_findings(out, log, event_days)


def summary(issues: DataFrame) -> DataFrame:
    """Count, symbols affected, first and last event per type and severity."""
    return (issues.groupBy("issue_type", "severity")
            .agg(F.count(F.lit(1)).alias("cnt"),
                 F.countDistinct("symbol").alias("symbols_affected"),
                 F.min("event_time").alias("first_seen"),
                 F.max("event_time").alias("last_seen"))
            .orderBy(F.desc("cnt"), "issue_type", "severity"))


def issue_rate(issues: DataFrame, trades: DataFrame, quotes: DataFrame) -> DataFrame:
    """Issues / (trades + quotes) × 100 as one row, from one pass over
    the three inputs (tagged union + one global aggregate, no join)."""
    tagged = (issues.select(F.lit(0).alias("_t"))
              .unionByName(trades.select(F.lit(1).alias("_t")))
              .unionByName(quotes.select(F.lit(2).alias("_t"))))
    c = tagged.agg(F.count_if(F.col("_t") == 0).alias("total_issues"),
                   F.count_if(F.col("_t") == 1).alias("trade_rows"),
                   F.count_if(F.col("_t") == 2).alias("quote_rows"))
    rows = F.col("trade_rows") + F.col("quote_rows")
    return c.withColumn("issue_pct", F.try_divide(F.col("total_issues").cast("double"),
                                                  rows.cast("double")) * F.lit(100.0))
