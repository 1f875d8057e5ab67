"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion into Spark's ``noop`` sink (every row is
computed, nothing is collected to the driver), ``BENCH_RUNS`` times (default
2).  ``queries`` / ``value`` are the best (warm) run per query; the first run
of each query, which includes code generation for the new plan, is reported
as ``cold`` / ``cold_total``.  Prints one JSON line.

``BENCH_EVENT_LOG_DIR`` (optional) writes Spark's event log there, for stage
and task times without the web UI.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tape.plans.catalog import QUERIES  # noqa: E402
from tape.session import get_session  # noqa: E402

HEADLINE = [
    "int_vwap", "int_volume_profile", "int_spread_analytics", "book_depth_arrays", "int_order_book_depth",
    "mart_daily_summary", "mart_data_quality_summary",
    "dq_stale", "dq_stale_blocked", "dq_outlier", "dq_outlier_halo", "dq_outlier_lineitem", "dq_scan",
    "asof_trade_quote", "asof_trade_quote_bucketed", "daily_spread_quantiles", "dq_outlier_range", "chk_not_null",
    "rep_vwap_series", "rep_spread_heatmap", "rep_daily_table", "rep_recent_issues", "rep_quality_rate",
]


def _default_memory() -> str:
    """8 GB, or 60 % of physical memory on a smaller machine."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        return f"{max(1024, min(8192, int(total * 0.6 / 2**20)))}m"
    except (ValueError, OSError, AttributeError):
        return "4g"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = sys.argv[1:] or HEADLINE
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", _default_memory()),
             "spark.ui.showConsoleProgress": "false"}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    spark = get_session(f"local[{cpus}]", app="tape-bench", shuffle_partitions=int(cpus) * 2, extra=extra)
    # warm-up: JVM, Parquet footers, codegen caches
    QUERIES["stg_trades"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    warm, cold = {}, {}
    for k in keys:
        got = []
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            got.append(time.perf_counter() - t0)
        cold[k] = round(got[0], 3)
        warm[k] = round(min(got), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_sec_headline_queries", "value": round(sum(warm.values()), 3),
                      "unit": "sec", "queries": warm, "cold": cold, "cold_total": round(sum(cold.values()), 3),
                      "runs": runs, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
