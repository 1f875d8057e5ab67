"""The model graph and the batch pipeline (§3.1, A3–A11, Q6–Q11).

``build_models`` wires the staging views, intermediate tables and marts as
lazy DataFrames (the graph of the source system: no mart reads an
intermediate model).  ``run_pipeline`` loads the raw tables by their contracts
(bad rows go to quarantine and into no model), writes every
table model day-partitioned, re-reads them (lineage is cut at each written
table, so a lost executor recomputes from Parquet, not from the raw input),
runs the table checks and writes the issue log.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tape.operators import bars, book, checks, marts, quality, staging
from tape.schemas import QUOTE_FLAGS, SIDES, TRADE_FLAGS
from tape.sources import contract, io

#: Flag domains of the staging views.
FLAGS = {"stg_trades": TRADE_FLAGS, "stg_quotes": QUOTE_FLAGS}

# model → (date column, sort columns) for written tables
TABLES = {
    "int_vwap": ("trade_date", ["symbol", "minute_bucket"]),
    "int_volume_profile": ("trade_date", ["symbol", "bucket_start"]),
    "int_spread_analytics": ("quote_date", ["symbol", "minute_bucket"]),
    "int_order_book_depth": ("snap_date", ["symbol", "minute_bucket"]),
    "mart_daily_summary": ("trade_date", ["symbol"]),
    "mart_data_quality_summary": ("issue_date", ["symbol", "issue_type"]),
}


def build_models(raw: dict[str, DataFrame], tie: Sequence[str] = (), exact: bool = True,
                 watch: checks.Watch | None = None) -> dict[str, DataFrame]:
    """Lazy frames for every model from ``trades``, ``quotes`` and (optional)
    ``order_book_snapshots``.  ``watch`` counts what the checks of the staging
    views look for while the minute bars read them."""
    def seen(name):
        if watch is None:
            return m[name]
        return watch.add(name, m[name], {"data_quality_flag": FLAGS[name]}, future=True)

    m: dict[str, DataFrame] = {}
    m["stg_trades"] = staging.stg_trades(raw["trades"], keep=tie)
    m["stg_quotes"] = staging.stg_quotes(raw["quotes"], keep=tie)
    m["int_vwap"] = bars.vwap_bars(seen("stg_trades"), tie=tie)
    m["int_volume_profile"] = bars.volume_profile(m["stg_trades"])
    m["int_spread_analytics"] = bars.spread_stats(seen("stg_quotes"), exact=exact)
    m["mart_daily_summary"] = marts.daily_summary(m["stg_trades"], m["stg_quotes"], tie=tie, exact=exact)
    m["mart_data_quality_summary"] = marts.data_quality_summary(m["stg_trades"], m["stg_quotes"])
    if "order_book_snapshots" in raw:
        snaps = raw["order_book_snapshots"]
        if "mid_price" not in snaps.columns:
            snaps = staging.enrich_book(snaps)
        m["stg_order_book"] = staging.stg_order_book(snaps)
        m["int_order_book_depth"] = book.order_book_depth(snaps, exact=exact, tie=tie)
    return m


def table_checks(models: dict[str, DataFrame], watch: checks.Watch) -> DataFrame:
    """Q7–Q11 as one frame (test, detail, failing_rows), empty tests included: what
    ``watch`` has counted while the models were written, and the checks that need
    passes of their own (repeated keys; the levels of the book)."""
    spark = models["stg_trades"].sparkSession
    failing = watch.failing()
    out = [spark.createDataFrame(failing, "test string, detail string, failing_rows long")]
    for test, _, n in failing:
        kind, _, target = test.partition(":")
        if kind == "accepted_values" and n:  # which values they are
            name, col = target.split(".")
            out.append(checks.accepted_values(models[name], col, FLAGS[name])
                       .select(F.lit(test).alias("test"), F.col("value").alias("detail"), F.col("n_records").alias("failing_rows")))
    for name in ("stg_trades", "stg_quotes"):
        out.append(checks.duplicates(models[name]).agg(F.count(F.lit(1)).alias("failing_rows"))
                   .select(F.lit(f"no_duplicates:{name}").alias("test"), F.lit("").alias("detail"), "failing_rows"))
    if "stg_order_book" in models:
        levels = models["stg_order_book"]
        out.append(checks.not_null(levels, checks.NOT_NULL["stg_order_book"], "stg_order_book")
                   .select(F.concat(F.lit("not_null:"), "model").alias("test"), F.col("column_name").alias("detail"), F.col("null_rows").alias("failing_rows")))
        out.append(checks.accepted_values(levels, "side", SIDES)
                   .select(F.lit("accepted_values:stg_order_book.side").alias("test"), F.col("value").alias("detail"), F.col("n_records").alias("failing_rows")))
    return reduce(DataFrame.unionByName, out)


def run_pipeline(spark: SparkSession, raw: dict[str, DataFrame], out_dir: str, as_of=None,
                 tie: Sequence[str] = (), write_raw: bool = True) -> dict[str, DataFrame]:
    """Load → stage → write models → checks → issue log.  Returns frames read
    back from the written tables (plus the check and issue summaries)."""
    as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    out_dir = out_dir.rstrip("/")
    src = dict(raw)
    if "order_book_snapshots" in src and "mid_price" not in src["order_book_snapshots"].columns:
        src["order_book_snapshots"] = staging.enrich_book(src["order_book_snapshots"])
    reports = []
    if write_raw:
        for name, df in src.items():
            path = f"{out_dir}/raw/{name}"
            contract.write_checked(df, name, path, load="run")
            schema = contract.placed(df, name).schema
            reports.append(contract.load_report(spark, name, path, schema))
            src[name] = contract.good(spark, path, schema).drop("date")
    watch = checks.Watch(as_of)
    models = build_models(src, tie=tie, watch=watch)
    written: dict[str, DataFrame] = {}
    for name, (date_col, order) in TABLES.items():
        if name in models:
            pct = 5.0 if name == "mart_daily_summary" else None
            io.write_table(models[name], f"{out_dir}/{name}", date_col=date_col, sort_cols=order,
                           watch=lambda df, name=name, pct=pct: watch.add(name, df, vwap_pct=pct))
            written[name] = spark.read.parquet(f"{out_dir}/{name}")
    log_path = f"{out_dir}/data_quality_issues"
    io.reset_issues(spark, log_path, src["quotes"].schema["timestamp"].dataType)
    findings = quality.scan(src["trades"], src["quotes"], as_of=as_of, tie=tie)
    io.append_issues(findings, log_path)
    issues = (spark.read.schema(io.issue_log_schema(src["quotes"].schema["timestamp"].dataType)).parquet(log_path)
              .drop(*io.ISSUE_DAYS))
    staged = {**models, **written}
    written["data_quality_issues"] = issues
    written["issue_summary"] = quality.summary(issues)
    written["issue_rate"] = quality.issue_rate(issues, src["trades"], src["quotes"])
    written["table_checks"] = table_checks(staged, watch)
    if reports:
        written["load_report"] = reduce(DataFrame.unionByName, reports)
    return written
