"""The batch pipeline end to end: written tables, checks, idempotent re-runs."""

import datetime as dt

from tape.plans import catalog as C
from tape.plans.pipeline import run_pipeline
from tests.conftest import SF_SMALL
from tests.util import bag, rows


def test_pipeline_is_idempotent_and_matches_lazy_models(spark, tmp_path):
    raw = {"trades": C.raw_trades(spark, SF_SMALL), "quotes": C.raw_quotes(spark, SF_SMALL),
           "order_book_snapshots": C.book(spark, SF_SMALL)}
    out_dir = str(tmp_path / "run")
    as_of = dt.datetime(2025, 1, 1)
    first = run_pipeline(spark, raw, out_dir, as_of=as_of, tie=["tick_id"])
    counts = {k: first[k].count() for k in ("int_vwap", "mart_daily_summary", "int_order_book_depth",
                                            "data_quality_issues")}
    assert bag(rows(first["mart_daily_summary"].select(*C.daily(spark, SF_SMALL).columns))) == \
        bag(rows(C.daily(spark, SF_SMALL)))
    checks = {r["test"]: r["failing_rows"] for r in rows(first["table_checks"]) if r["detail"] == ""}
    assert checks["no_duplicates:stg_trades"] == 0 and checks["no_future:stg_quotes"] == 0
    second = run_pipeline(spark, raw, out_dir, as_of=as_of, tie=["tick_id"])
    assert {k: second[k].count() for k in counts} == counts


def test_report_time_range_prunes_day_partitions(spark, tmp_path):
    from tape.operators import bars
    from tape.plans import reports
    from tape.sources import io
    path = str(tmp_path / "int_vwap")
    io.write_table(bars.vwap_bars(C.trades(spark, SF_SMALL), tie=["tick_id"]), path, date_col="trade_date",
                   sort_cols=["symbol", "minute_bucket"])
    table = spark.read.parquet(path)
    r = reports.vwap_series(table, "2024-01-10 00:00:00", "2024-01-12 23:59:59", ["click_0", "view_1"])
    plan = spark._jvm.PythonSQLUtils.explainString(r._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(trade_date" in plan and "(trade_date#" in plan
    assert "PushedFilters: [" in plan and "In(symbol, [click_0,view_1])" in plan
    got = rows(r)
    assert got and all(dt.date(2024, 1, 10) <= x["time"].date() <= dt.date(2024, 1, 12) for x in got)


def test_sizes_of_files_plan_no_broadcast(spark, tmp_path):
    """Sorted ticks with few values are small in Parquet, whatever their number: the
    ranked rows must not be broadcast, only what is measured as small."""
    from pyspark.sql import functions as F
    from tape.operators import windows
    path = str(tmp_path / "ticks")
    (spark.range(20_000).select(F.lit("A").alias("symbol"), F.timestamp_micros((F.col("id") / 1000).cast("long") * 60_000_000).alias("timestamp"),
                                F.col("id").alias("tick_id")).write.parquet(path))
    x = windows.previous(spark.read.parquet(path), "tick_id", ["symbol"], ["timestamp", "tick_id"], "before", block_rows=5000)
    assert "Broadcast" not in spark._jvm.PythonSQLUtils.explainString(x._jdf.queryExecution(), "simple")
    assert x.where("before = tick_id - 1 or (before is null and tick_id = 0)").count() == 20_000
