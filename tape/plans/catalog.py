"""Registered queries: name → ``fn(spark, sf_dir) -> DataFrame``.

Every query reads the whole test tables (through the tick views of
``tape.sources.fixtures``) and runs the library operators on them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tape.functions.time import epoch_micros, from_epoch_micros, millis_between, tick_time_text
from tape.operators import asof, bars, checks, flags, marts, quality, resume, sizes, sketches, staging
from tape.operators import book as book_ops
from tape.plans import reports
from tape.schemas import CSV_TIMESTAMP_FORMAT, ISSUE_COLUMNS, QUOTE_FLAGS, SIDES, TRADE_FLAGS
from tape.sources import contract, io, tables
from tape.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
TIE = fx.EVENTS_TIE


# --- inputs -----------------------------------------------------------------
def _events(spark, sf):
    return fx.table(spark, sf, "events")


def trades(spark, sf):
    return staging.stg_trades(fx.trades_from_events(_events(spark, sf)), keep=TIE)


def quotes(spark, sf):
    return staging.stg_quotes(fx.quotes_from_events(_events(spark, sf)), keep=TIE)


def raw_trades(spark, sf):
    return fx.trades_from_events(_events(spark, sf))


def raw_quotes(spark, sf):
    return fx.quotes_from_events(_events(spark, sf))


def book(spark, sf):
    return staging.enrich_book(fx.book_from_events(_events(spark, sf)))


def li_trades(spark, sf):
    return staging.stg_trades(fx.trades_from_lineitem(fx.table(spark, sf, "lineitem")), keep=fx.LINEITEM_TIE)


# --- staging ------------------------------------------------------------------
def q_stg_trades(spark, sf):
    return trades(spark, sf)


def q_stg_quotes(spark, sf):
    return quotes(spark, sf)


def q_stg_order_book(spark, sf):
    return staging.stg_order_book(book(spark, sf))


def q_book_enriched(spark, sf):
    return book(spark, sf)


# --- bars ---------------------------------------------------------------------
def q_int_vwap(spark, sf):
    return bars.vwap_bars(trades(spark, sf), tie=TIE)


def q_int_vwap_lineitem(spark, sf):
    return bars.vwap_bars(li_trades(spark, sf), tie=fx.LINEITEM_TIE)


def q_int_volume_profile(spark, sf):
    return bars.volume_profile(trades(spark, sf))


def q_int_volume_profile_lineitem(spark, sf):
    return bars.volume_profile(li_trades(spark, sf))


def q_int_spread_analytics(spark, sf):
    return bars.spread_stats(quotes(spark, sf))


def q_spread_hourly(spark, sf):
    """D7 with hour buckets: several quotes per group, so the quantiles interpolate."""
    return bars.spread_stats(quotes(spark, sf), seconds=3600)


# --- book depth ---------------------------------------------------------------
def q_int_order_book_depth(spark, sf):
    """The model as written: explode to levels, regroup to snapshots, then minutes."""
    return book_ops.order_book_depth(book(spark, sf), tie=TIE, exploded=True)


def q_book_depth_arrays(spark, sf):
    """Same result from the arrays: no explode, one exchange."""
    return book_ops.order_book_depth(book(spark, sf), tie=TIE)


# --- quality findings -----------------------------------------------------------
AS_OF = dt.datetime(2025, 1, 1)
FINDING = ["source_table", "symbol", "event_time", "issue_type", "severity"]


def q_dq_crossed(spark, sf):
    return quality.crossed_spreads(raw_quotes(spark, sf), AS_OF).drop("detected_at")


def q_dq_stale(spark, sf):
    """Stale check with the library defaults."""
    return quality.stale_quotes(raw_quotes(spark, sf), tie=TIE, as_of=AS_OF).drop("detected_at")


def q_dq_stale_blocked(spark, sf):
    """Stale check with small blocks, so that rows are copied between blocks."""
    return quality.stale_quotes(raw_quotes(spark, sf), tie=TIE, block_rows=50,
                                as_of=AS_OF).drop("detected_at")


def q_dq_stale_daily(spark, sf):
    return quality.stale_quotes(raw_quotes(spark, sf), tie=TIE, reset_daily=True, as_of=AS_OF).drop("detected_at")


def q_dq_outlier(spark, sf):
    """Outlier check with the library defaults."""
    return (quality.price_outliers(raw_trades(spark, sf), tie=TIE, as_of=AS_OF)
            .select(*FINDING, "trade_price"))


def q_dq_outlier_halo(spark, sf):
    """Outlier check with small blocks: 1000-row frames over blocks of 1000 + 999 halo rows."""
    return (quality.price_outliers(raw_trades(spark, sf), tie=TIE, block_rows=1000, as_of=AS_OF)
            .select(*FINDING, "trade_price"))


def q_dq_outlier_lineitem(spark, sf):
    t = fx.trades_from_lineitem(fx.table(spark, sf, "lineitem"))
    return (quality.price_outliers(t, tie=fx.LINEITEM_TIE, block_rows=1000, as_of=AS_OF)
            .select(*FINDING, "trade_price"))


def q_dq_outlier_range(spark, sf):
    """Outlier check on the blocked plan with range-partitioned ranking (skew-proof
    even when one symbol-minute is huge), on the lineitem tape."""
    t = fx.trades_from_lineitem(fx.table(spark, sf, "lineitem"))
    return (quality.price_outliers(t, tie=fx.LINEITEM_TIE, block_rows=1000, rank="range",
                                   as_of=AS_OF)
            .select(*FINDING, "trade_price"))


def q_dq_zero_trades(spark, sf):
    return quality.zero_size_trades(raw_trades(spark, sf), AS_OF).drop("detected_at")


def q_dq_zero_quotes(spark, sf):
    return quality.zero_size_quotes(raw_quotes(spark, sf), AS_OF).drop("detected_at")


def issue_log(spark, sf):
    return quality.scan(raw_trades(spark, sf), raw_quotes(spark, sf), as_of=AS_OF, tie=TIE)


def q_dq_scan(spark, sf):
    return issue_log(spark, sf).drop("detected_at")


#: Slices that the registered scan by slices takes its ticks in.
SLICES = 5


def q_dq_scan_slices(spark, sf):
    """Q6 resumed: the ticks in slices of days, each run reading its own days and
    the small state of the run before."""
    t, q = raw_trades(spark, sf), raw_quotes(spark, sf)
    first, last = q.unionByName(t, allowMissingColumns=True).agg(F.min("timestamp"), F.max("timestamp")).first()
    days = (last.date() - first.date()).days + 1
    base = _scratch(spark, "scan-slices")
    ends = [first.date() + dt.timedelta(days=days * k // SLICES) for k in range(SLICES + 1)]
    for run, (a, b) in enumerate(zip(ends, ends[1:]), 1):
        mine = F.to_date("timestamp").between(F.lit(a), F.lit(b - dt.timedelta(days=1)))
        resume.scan_slice(spark, t.where(mine), q.where(mine), base, run, as_of=AS_OF, tie=TIE, event_days=(a, b))
    return resume.findings(spark, base, q.schema["timestamp"].dataType).select(*[c for c in ISSUE_COLUMNS if c != "detected_at"])


def q_dq_incremental(spark, sf):
    """A second run against a log that already holds the row-wise findings:
    only the window findings are new."""
    t, q = raw_trades(spark, sf), raw_quotes(spark, sf)
    prior = (quality.crossed_spreads(q, AS_OF)
             .unionByName(quality.zero_size_trades(t, AS_OF))
             .unionByName(quality.zero_size_quotes(q, AS_OF)))
    return quality.scan(t, q, log=prior, as_of=AS_OF, tie=TIE).select(*FINDING)


def q_dq_summary(spark, sf):
    return quality.summary(issue_log(spark, sf))


def q_dq_rate(spark, sf):
    return quality.issue_rate(issue_log(spark, sf), raw_trades(spark, sf), raw_quotes(spark, sf))


# --- marts ------------------------------------------------------------------------
def daily(spark, sf):
    return marts.daily_summary(trades(spark, sf), quotes(spark, sf), tie=TIE)


def q_mart_daily_summary(spark, sf):
    return daily(spark, sf)


def q_daily_spread_quantiles(spark, sf):
    """D9/D10 at scale: exact daily median and p95 spread without a per-group map."""
    from tape.operators.quantiles import exact_quantiles
    return exact_quantiles(quotes(spark, sf), ["symbol", "quote_date"], "spread_bps", [0.5, 0.95],
                           ["median_spread_bps", "p95_spread_bps"])


def q_spread_sketches(spark, sf):
    """D9/D10 by stored sketches: minutes written as a table, merged to symbols;
    whether the ranks of the answers are within the sketch's error."""
    path = _scratch(spark, "sketches")
    q = quotes(spark, sf)
    io.write_table(sketches.minute_sketches(q), path, date_col="quote_date", sort_cols=["symbol", "minute_bucket"])
    names, qs = ["median_spread_bps", "p95_spread_bps"], [0.5, 0.95]
    answers = sketches.roll_up(spark.read.parquet(path), ["symbol"], qs, names)
    errors = sketches.rank_errors(q, ["symbol"], "spread_bps", answers, qs, names)
    return errors.select("symbol", "n", *[(F.col(f"error_{x}") <= sketches.RANK_ERROR).alias(f"{x}_within") for x in names])


def q_daily_summary_declared(spark, sf):
    """The daily mart over declared tables: bucketed by symbol and day, so that
    neither side of the daily join is exchanged."""
    names = {}
    for name, df in (("stg_trades", trades(spark, sf)), ("stg_quotes", quotes(spark, sf))):
        names[name] = tables.unique(name)
        tables.declare(spark, name, names[name], _scratch(spark, name), extra="tick_id BIGINT")
        tables.fill(df, name, names[name])
    return marts.daily_summary(spark.table(names["stg_trades"]), spark.table(names["stg_quotes"]), tie=TIE)


def q_symbols_by_view(spark, sf):
    """A10: SQL over a model's view."""
    name = tables.unique("stg_trades")
    io.as_view(trades(spark, sf), name)
    return spark.sql(f"SELECT symbol, count(*) AS trade_count, sum(trade_size) AS total_volume FROM {name} WHERE NOT has_quality_issue GROUP BY symbol")


def q_mart_data_quality_summary(spark, sf):
    return marts.data_quality_summary(trades(spark, sf), quotes(spark, sf))


# --- table checks -------------------------------------------------------------------
def q_chk_not_null(spark, sf):
    """Q7 over every model with declared columns; the raw tables have missing
    values here, so that the check has something to find.  Each tick table is read
    once: the counts come with the pass that stages it and with one pass over the
    models of the staged tables."""
    from tape.session import materialise
    watch = checks.Watch()

    def holed(df, name, c, k):
        whole = df.withColumn("_whole", F.col(c)).withColumn(c, F.when(F.col("tick_id") % k != 5, F.col(c)))
        return watch.add(name, whole).withColumn(c, F.col("_whole")).drop("_whole")
    t = materialise(watch.add("stg_trades", staging.stg_trades(holed(raw_trades(spark, sf), "trades", "trade_price", 97), keep=TIE)), "checked-trades")
    q = materialise(watch.add("stg_quotes", staging.stg_quotes(holed(raw_quotes(spark, sf), "quotes", "bid_price", 89), keep=TIE)), "checked-quotes")
    b = materialise(holed(book(spark, sf), "order_book_snapshots", "mid_price", 83), "checked-book")
    models = {
        "stg_order_book": staging.stg_order_book(b), "int_vwap": bars.vwap_bars(t, tie=TIE), "int_spread_analytics": bars.spread_stats(q),
        "int_order_book_depth": book_ops.order_book_depth(b, tie=TIE), "mart_daily_summary": marts.daily_summary(t, q, tie=TIE),
        "mart_data_quality_summary": marts.data_quality_summary(t, q),
    }
    passes = [watch.add(name, df).select(F.lit(name).alias("model")) for name, df in models.items()]
    reduce(DataFrame.unionByName, passes).write.format("noop").mode("overwrite").save()
    found = [(test.partition(":")[2], column, n) for test, column, n in watch.failing() if n]
    return spark.createDataFrame(found, "model string, column_name string, null_rows long")


def q_chk_accepted(spark, sf):
    """Q8: flag domains of trades and quotes and the book side domain; the
    trade check is run against the narrower generated set to show failures."""
    t = checks.accepted_values(trades(spark, sf), "data_quality_flag", ["OK", "MISSING_FIELD"])
    q = checks.accepted_values(quotes(spark, sf), "data_quality_flag", QUOTE_FLAGS)
    s = checks.accepted_values(staging.stg_order_book(book(spark, sf)), "side", SIDES)
    f = checks.accepted_values(trades(spark, sf), "data_quality_flag", TRADE_FLAGS)
    return (t.withColumn("test", F.lit("trade_flag_generated"))
            .unionByName(q.withColumn("test", F.lit("quote_flag")))
            .unionByName(s.withColumn("test", F.lit("book_side")))
            .unionByName(f.withColumn("test", F.lit("trade_flag"))))


def q_chk_dup(spark, sf):
    """Q9 on the lineitem tape, which has real (symbol, timestamp) repeats."""
    return checks.duplicates(li_trades(spark, sf))


def q_chk_dup_quotes(spark, sf):
    return checks.duplicates(quotes(spark, sf))


def q_chk_dup_rows(spark, sf):
    """Q9 variant (S6): ticks repeated in every column, on the lineitem tape."""
    t = li_trades(spark, sf).drop(*fx.LINEITEM_TIE)
    return checks.full_row_duplicates(t)


def q_chk_future(spark, sf):
    """Q10 with a fixed 'now' inside the data range."""
    return checks.future_rows(trades(spark, sf), dt.datetime(2024, 1, 30, 12, 0, 0),
                              cols=["symbol", "timestamp", "trade_price"])


def q_chk_future_quotes(spark, sf):
    """Q10 on the quotes."""
    return checks.future_rows(quotes(spark, sf), dt.datetime(2024, 1, 30, 12, 0, 0), cols=["symbol", "timestamp", "bid_price", "ask_price"])


def q_chk_vwap_range(spark, sf):
    return checks.vwap_out_of_range(daily(spark, sf))


# --- reports ------------------------------------------------------------------------
START, END = "2024-01-03 00:00:00", "2024-01-28 23:59:59"
SYMS = ["click_0", "click_1", "view_2", "purchase_3", "error_4", "signup_0"]
ONE = "click_2"


def _vwap(spark, sf):
    return bars.vwap_bars(trades(spark, sf), tie=TIE)


def _spread(spark, sf):
    return bars.spread_stats(quotes(spark, sf))


def _profile(spark, sf):
    return bars.volume_profile(trades(spark, sf))


def q_rep_vwap_series(spark, sf):
    return reports.vwap_series(_vwap(spark, sf), START, END, SYMS)


def q_rep_volume_by_symbol(spark, sf):
    return reports.volume_by_symbol(_vwap(spark, sf), START, END)


def q_rep_spread_heatmap(spark, sf):
    return reports.spread_heatmap(_spread(spark, sf), START, END, SYMS)


def q_rep_volume_time_of_day(spark, sf):
    return reports.volume_by_time_of_day(_profile(spark, sf), START, END, SYMS)


def q_rep_daily_table(spark, sf):
    return reports.daily_summary_table(daily(spark, sf), START, END, SYMS)


def q_rep_tick_chart(spark, sf):
    return reports.tick_chart(raw_trades(spark, sf), ONE, START, END)


def q_rep_ohlc(spark, sf):
    return reports.ohlc(_vwap(spark, sf), ONE, START, END)


def q_rep_spread_evolution(spark, sf):
    return reports.spread_evolution(_spread(spark, sf), ONE, START, END)


def q_rep_volume_buckets(spark, sf):
    return reports.volume_by_bucket(_profile(spark, sf), ONE, START, END)


def q_rep_size_histogram(spark, sf):
    return reports.trade_size_histogram(raw_trades(spark, sf), ONE, START, END, width=10)


def q_rep_size_sample(spark, sf):
    return reports.trade_sizes(raw_trades(spark, sf), ONE, START, END, tie=TIE)


def q_rep_daily_stats(spark, sf):
    return reports.daily_stats(daily(spark, sf), ONE)


def q_rep_symbol_issues(spark, sf):
    return reports.symbol_issues(issue_log(spark, sf), ONE, START, END, k=100)


def q_rep_issues_over_time(spark, sf):
    return reports.issues_over_time(issue_log(spark, sf), START, END, SYMS, time_col="event_time")


def q_rep_issue_types(spark, sf):
    return reports.issue_count_by_type(issue_log(spark, sf), START, END, SYMS, time_col="event_time")


def q_rep_issues_by_symbol(spark, sf):
    return reports.issues_by_symbol(issue_log(spark, sf), START, END, k=50, time_col="event_time")


def q_rep_severity(spark, sf):
    return reports.severity_breakdown(issue_log(spark, sf), START, END, time_col="event_time")


def q_rep_quality_rate(spark, sf):
    return reports.quality_rate(issue_log(spark, sf), raw_trades(spark, sf), raw_quotes(spark, sf))


def q_rep_recent_issues(spark, sf):
    return reports.recent_issues(issue_log(spark, sf), START, END, SYMS, k=200, time_col="event_time")


def q_rep_symbols(spark, sf):
    return reports.symbol_options(raw_trades(spark, sf))


# --- sources, sinks, flags, calendar, as-of -------------------------------------------
def _scratch(spark, name):
    import uuid
    from tape.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/tape-{name}-{uuid.uuid4().hex[:12]}"


def q_csv_roundtrip(spark, sf):
    """Raw trades → CSV → typed read with the fixed schema."""
    path = _scratch(spark, "trades-csv")
    t = io.conform(raw_trades(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp")), "trades")
    io.write_csv(t, path)
    return io.read_csv(spark, "trades", path).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def q_book_csv_roundtrip(spark, sf):
    """Book arrays as JSON text in CSV, decoded back to arrays."""
    path = _scratch(spark, "book-csv")
    b = io.conform(book(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp")),
                   "order_book_snapshots")
    io.write_csv(b, path)
    return (io.read_csv(spark, "order_book_snapshots", path)
            .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
)


def q_load_quarantine(spark, sf):
    """Trades as CSV text with planted faults, loaded twice by the
    contract; what is written as good and as bad."""
    t, k = raw_trades(spark, sf), F.col("tick_id") % 101
    text = t.select(
        F.when(k != 19, F.col("symbol")).alias("symbol"),
        F.when(k == 7, "yesterday").otherwise(F.date_format("timestamp", CSV_TIMESTAMP_FORMAT)).alias("timestamp"),
        F.when(k == 3, "n/a").when(k != 5, F.col("trade_price").cast("string")).alias("trade_price"),
        F.when(k.isin(17, 23), "-1").otherwise(F.col("trade_size").cast("string")).alias("trade_size"),
        "exchange", "trade_condition",
        F.when(k.isin(11, 23), "BOGUS").when(k != 13, F.col("data_quality_flag")).alias("data_quality_flag"))
    csv, out = _scratch(spark, "faults-csv"), _scratch(spark, "faults")
    text.write.option("header", True).csv(csv)
    for _ in range(2):
        contract.write_checked(contract.read_checked(spark, "trades", csv), "trades", out, load="planted")
    return contract.load_report(spark, "trades", out)


def q_partitioned_load(spark, sf):
    """Day-partitioned sorted write, loaded twice (idempotent),
    then the post-load count check."""
    path = _scratch(spark, "stg-trades")
    src = trades(spark, sf)
    io.write_table(src, path, date_col="trade_date")
    io.write_table(src, path, date_col="trade_date")   # second load replaces the same days
    return io.verify_counts(src, spark.read.parquet(path), "stg_trades")


def q_flag_rules_quotes(spark, sf):
    """Q12: quote flags derived from the data (crossed, zero size, wide > 50 bps)."""
    return flags.flag_quotes(raw_quotes(spark, sf), wide_bps=50.0).select(
        "symbol", "timestamp", "tick_id", "data_quality_flag")


def q_flag_rules_book(spark, sf):
    return flags.flag_book(fx.book_from_events(_events(spark, sf))).select(
        "symbol", "timestamp", "tick_id", "data_quality_flag")


def q_flag_rules(spark, sf):
    """Q12 over all three tick tables: the derived flag per tick, tagged by table."""
    tag = lambda df, name: df.withColumn("source_table", F.lit(name))
    return (tag(q_flag_rules_trades(spark, sf), "trades")
            .unionByName(tag(q_flag_rules_quotes(spark, sf), "quotes"))
            .unionByName(tag(q_flag_rules_book(spark, sf), "order_book_snapshots")))


def _sized_trades(spark, sf):
    """Every 53rd trade a block trade, so that there is something to find."""
    t = raw_trades(spark, sf).select("symbol", "timestamp", "tick_id", "trade_size")
    return t.withColumn("trade_size", F.when(F.col("tick_id") % 53 == 7, F.col("trade_size") * 1000).otherwise(F.col("trade_size")))


def q_tick_time_forms(spark, sf):
    """A tick's time as microseconds, as text, back from microseconds, and
    its distance from noon in milliseconds."""
    t = raw_trades(spark, sf).select("tick_id", "timestamp", epoch_micros("timestamp").alias("epoch_us"))
    back = from_epoch_micros("epoch_us").cast("timestamp_ntz")
    noon = F.date_trunc("DAY", "timestamp").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOUR")
    return t.select("tick_id", "epoch_us", tick_time_text("timestamp").alias("time_text"), back.alias("back"), millis_between(noon, "timestamp").alias("noon_ms"))


def q_size_outliers(spark, sf):
    """Q12 SIZE_OUTLIER: rolling median and deviation, blocks of 1000 + 999 rows."""
    return sizes.size_outliers(_sized_trades(spark, sf), tie=TIE, block_rows=1000).where("is_size_outlier").drop("is_size_outlier")


def q_trading_days(spark, sf):
    return staging.trading_days(raw_trades(spark, sf))


def q_asof_trade_quote(spark, sf):
    """Trades with the prevailing earlier quote of the same symbol."""
    t = raw_trades(spark, sf).select("symbol", "timestamp", "tick_id", "trade_price", "trade_size")
    q = raw_quotes(spark, sf).select("symbol", "timestamp", "tick_id", "bid_price", "ask_price")
    return asof.prevailing(t, q, ["bid_price", "ask_price"], right_tie=TIE, strict=True)


def q_asof_trade_quote_bucketed(spark, sf):
    """The as-of join with the buckets' width given by the caller (here a minute,
    which is the default too)."""
    t = raw_trades(spark, sf).select("symbol", "timestamp", "tick_id", "trade_price", "trade_size")
    q = raw_quotes(spark, sf).select("symbol", "timestamp", "tick_id", "bid_price", "ask_price")
    return asof.prevailing(t, q, ["bid_price", "ask_price"], right_tie=TIE, strict=True, coarse_seconds=60)


def q_flag_rules_trades(spark, sf):
    """Q12 on trades: zero size, or more than 5 % away from the prevailing quote mid."""
    t = raw_trades(spark, sf).select("symbol", "timestamp", "tick_id", "trade_price", "trade_size")
    q = raw_quotes(spark, sf).select("symbol", "timestamp", "tick_id", "bid_price", "ask_price")
    j = asof.prevailing(t, q, ["bid_price", "ask_price"], right_tie=TIE, strict=True)
    j = j.withColumn("q_mid", (F.col("q_bid_price") + F.col("q_ask_price")) / F.lit(2.0))
    return flags.flag_trades(j, reference_price="q_mid").select("symbol", "timestamp", "tick_id",
                                                                "data_quality_flag")


# --- pipeline and streaming ----------------------------------------------------------
#: Runs of the batch pipeline that this process has made: (application, data) → frames.
_RUNS: dict[tuple[str, str], dict[str, DataFrame]] = {}


def batch_run(spark, sf):
    """The whole batch pipeline on the event ticks, books included; several
    registered queries show what one run has written."""
    from tape.plans.pipeline import run_pipeline
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        raw = {"trades": raw_trades(spark, sf), "quotes": raw_quotes(spark, sf), "order_book_snapshots": book(spark, sf)}
        _RUNS[key] = run_pipeline(spark, raw, _scratch(spark, "batch-run"), as_of=AS_OF, tie=TIE)
    return _RUNS[key]


def q_batch_run_daily_summary(spark, sf):
    """The daily mart that the batch pipeline has written."""
    return batch_run(spark, sf)["mart_daily_summary"].select(*daily(spark, sf).columns)


def q_batch_run_depth(spark, sf):
    """The book model that the batch pipeline has written."""
    return batch_run(spark, sf)["int_order_book_depth"]


def q_batch_run_issues(spark, sf):
    """The issue log that the batch pipeline has written."""
    return batch_run(spark, sf)["data_quality_issues"].drop("detected_at")


def q_batch_run_checks(spark, sf):
    """Q7-Q11 as the batch pipeline reports them, with the load report's totals."""
    run = batch_run(spark, sf)
    loaded = run["load_report"].select(F.concat_ws(":", F.lit("load"), "table").alias("test"), F.concat_ws("", "verdict", "fault").alias("detail"), F.col("n_rows").alias("failing_rows"))
    return run["table_checks"].unionByName(loaded)


def q_batch_run_summary(spark, sf):
    """The issue summary of the batch pipeline's run."""
    return batch_run(spark, sf)["issue_summary"]


def _event_stream(spark, sf, end_dir=None):
    from tape.streaming import run as srun
    return srun.tick_stream(spark, sf, "events.parquet", end_dir=end_dir)


def _closed_stream(spark, sf):
    """The event ticks as a stream, and the function that ends it: a last tick
    two days after the others, inside session hours."""
    from tape.streaming import run as srun
    end_dir = srun.scratch(spark, "end")
    stream = _event_stream(spark, sf, end_dir)

    def end():
        ev = _events(spark, sf)
        last = ev.agg(F.max("ts")).first()[0]
        at = dt.datetime.combine(last.date() + dt.timedelta(days=2), dt.time(15))
        srun.write_end_tick(spark, ev.schema, end_dir, event_id=0, event_type="end", user_id=0, ts=at, value=1.0, props='{"k": 1}')
    return stream, end


def q_stream_vwap_bars(spark, sf):
    """Minute bars from a stream, all of them: the end of input closes the
    windows that the watermark had not passed."""
    from tape.streaming import run as srun, ticks as st
    ev, end = _closed_stream(spark, sf)
    t = staging.stg_trades(st.event_time(fx.trades_from_events(ev)), keep=TIE)
    out = srun.run_to_parquet(st.vwap_bars(t, tie=TIE), "vwap", end)
    return out.withColumn("minute_bucket", F.col("minute_bucket").cast("timestamp_ntz"))


def q_stream_volume_profile(spark, sf):
    """5-minute volume profile from a stream."""
    from tape.streaming import run as srun, ticks as st
    ev, end = _closed_stream(spark, sf)
    t = staging.stg_trades(st.event_time(fx.trades_from_events(ev)))
    out = srun.run_to_parquet(st.volume_profile(t), "profile", end)
    return out.withColumn("bucket_start", F.col("bucket_start").cast("timestamp_ntz"))


def q_stream_dedup(spark, sf):
    """The same input delivered twice comes out once."""
    from tape.streaming import run as srun, ticks as st
    a = st.event_time(fx.trades_from_events(_event_stream(spark, sf)))
    b = st.event_time(fx.trades_from_events(_event_stream(spark, sf)))
    out = srun.run_to_parquet(st.drop_repeated_ticks(a.unionByName(b), ["symbol", "timestamp", "tick_id"]), "dedup")
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def q_stream_stale(spark, sf):
    """Stale-quote gaps with per-symbol event-time state, all of them: the
    end of input finalises the pending ticks."""
    from tape.streaming import run as srun, ticks as st
    ev, end = _closed_stream(spark, sf)
    q = st.event_time(fx.quotes_from_events(ev))
    out = srun.run_to_parquet(st.stale_quotes(q, tie="tick_id"), "stale", end)
    return out.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def q_stream_checks_sink(spark, sf):
    """T4: row-wise quote and trade checks appended per micro-batch; the quotes
    are delivered twice in later batches, which adds nothing."""
    from tape.streaming import run as srun, ticks as st
    base = srun.scratch(spark, "log")
    for k, (table, make) in enumerate((("quotes", fx.quotes_from_events), ("trades", fx.trades_from_events), ("quotes", fx.quotes_from_events))):
        srun.run_foreach_batch(make(_event_stream(spark, sf)), st.checks_to_log(f"{base}/log", AS_OF, table), f"checks{k}")
    return spark.read.parquet(f"{base}/log").drop("detected_at", "event_date")


QUERIES: dict[str, Query] = {
    "stg_trades": q_stg_trades,
    "stg_quotes": q_stg_quotes,
    "stg_order_book": q_stg_order_book,
    "book_enriched": q_book_enriched,
    "int_vwap": q_int_vwap,
    "int_vwap_lineitem": q_int_vwap_lineitem,
    "int_volume_profile": q_int_volume_profile,
    "int_volume_profile_lineitem": q_int_volume_profile_lineitem,
    "int_spread_analytics": q_int_spread_analytics,
    "spread_hourly": q_spread_hourly,
    "int_order_book_depth": q_int_order_book_depth,
    "book_depth_arrays": q_book_depth_arrays,
    "dq_crossed": q_dq_crossed,
    "dq_stale": q_dq_stale,
    "dq_stale_blocked": q_dq_stale_blocked,
    "dq_stale_daily": q_dq_stale_daily,
    "dq_outlier": q_dq_outlier,
    "dq_outlier_halo": q_dq_outlier_halo,
    "dq_outlier_lineitem": q_dq_outlier_lineitem,
    "dq_outlier_range": q_dq_outlier_range,
    "dq_zero_trades": q_dq_zero_trades,
    "dq_zero_quotes": q_dq_zero_quotes,
    "dq_scan": q_dq_scan,
    "dq_incremental": q_dq_incremental,
    "dq_scan_slices": q_dq_scan_slices,
    "dq_summary": q_dq_summary,
    "dq_rate": q_dq_rate,
    "mart_daily_summary": q_mart_daily_summary,
    "spread_sketches": q_spread_sketches,
    "daily_summary_declared": q_daily_summary_declared,
    "symbols_by_view": q_symbols_by_view,
    "mart_data_quality_summary": q_mart_data_quality_summary,
    "daily_spread_quantiles": q_daily_spread_quantiles,
    "chk_not_null": q_chk_not_null,
    "chk_accepted": q_chk_accepted,
    "chk_dup": q_chk_dup,
    "chk_dup_quotes": q_chk_dup_quotes,
    "chk_dup_rows": q_chk_dup_rows,
    "chk_future": q_chk_future,
    "chk_future_quotes": q_chk_future_quotes,
    "chk_vwap_range": q_chk_vwap_range,
    "rep_vwap_series": q_rep_vwap_series,
    "rep_volume_by_symbol": q_rep_volume_by_symbol,
    "rep_spread_heatmap": q_rep_spread_heatmap,
    "rep_volume_time_of_day": q_rep_volume_time_of_day,
    "rep_daily_table": q_rep_daily_table,
    "rep_tick_chart": q_rep_tick_chart,
    "rep_ohlc": q_rep_ohlc,
    "rep_spread_evolution": q_rep_spread_evolution,
    "rep_volume_buckets": q_rep_volume_buckets,
    "rep_size_histogram": q_rep_size_histogram,
    "rep_size_sample": q_rep_size_sample,
    "rep_daily_stats": q_rep_daily_stats,
    "rep_symbol_issues": q_rep_symbol_issues,
    "rep_issues_over_time": q_rep_issues_over_time,
    "rep_issue_types": q_rep_issue_types,
    "rep_issues_by_symbol": q_rep_issues_by_symbol,
    "rep_severity": q_rep_severity,
    "rep_quality_rate": q_rep_quality_rate,
    "rep_recent_issues": q_rep_recent_issues,
    "rep_symbols": q_rep_symbols,
    "csv_roundtrip": q_csv_roundtrip,
    "book_csv_roundtrip": q_book_csv_roundtrip,
    "load_quarantine": q_load_quarantine,
    "partitioned_load": q_partitioned_load,
    "flag_rules": q_flag_rules,
    "flag_rules_quotes": q_flag_rules_quotes,
    "flag_rules_book": q_flag_rules_book,
    "flag_rules_trades": q_flag_rules_trades,
    "size_outliers": q_size_outliers,
    "tick_time_forms": q_tick_time_forms,
    "trading_days": q_trading_days,
    "asof_trade_quote": q_asof_trade_quote,
    "asof_trade_quote_bucketed": q_asof_trade_quote_bucketed,
    "batch_run_daily_summary": q_batch_run_daily_summary,
    "batch_run_depth": q_batch_run_depth,
    "batch_run_issues": q_batch_run_issues,
    "batch_run_checks": q_batch_run_checks,
    "batch_run_summary": q_batch_run_summary,
    "stream_vwap_bars": q_stream_vwap_bars,
    "stream_volume_profile": q_stream_volume_profile,
    "stream_dedup": q_stream_dedup,
    "stream_stale": q_stream_stale,
    "stream_checks_sink": q_stream_checks_sink,
}
