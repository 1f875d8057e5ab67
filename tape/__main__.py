"""Command line: the batch flow of the source system as three commands.

    python -m tape load   --csv DIR --out DIR       # CSV ticks → day-partitioned Parquet
    python -m tape run    --raw DIR --out DIR       # models, issue log, table checks
    python -m tape report NAME --out DIR [--start T] [--end T] [--symbol S ...] [--save DIR]

``load`` keeps rows that break a table's contract apart from the others (see
``tape.sources.contract``).  ``DIR`` of ``load`` holds ``trades.csv``, ``quotes.csv`` and (optional)
``order_book_snapshots.csv`` (files or folders).  Only small aggregated results
(check results, issue summary, report heads) are printed; everything else is
written as Parquet.  Runs on whatever master ``spark-submit`` provides.
"""

from __future__ import annotations

import argparse
import sys

from tape.session import get_session

RAW_TABLES = ("trades", "quotes", "order_book_snapshots")

# report name → (function, input model, extra keyword arguments)
REPORTS = {
    "vwap_series": ("vwap_series", "int_vwap"),
    "volume_by_symbol": ("volume_by_symbol", "int_vwap"),
    "spread_heatmap": ("spread_heatmap", "int_spread_analytics"),
    "volume_by_time_of_day": ("volume_by_time_of_day", "int_volume_profile"),
    "daily_summary_table": ("daily_summary_table", "mart_daily_summary"),
    "ohlc": ("ohlc", "int_vwap"),
    "spread_evolution": ("spread_evolution", "int_spread_analytics"),
    "volume_by_bucket": ("volume_by_bucket", "int_volume_profile"),
    "daily_stats": ("daily_stats", "mart_daily_summary"),
    "symbol_issues": ("symbol_issues", "data_quality_issues"),
    "issues_over_time": ("issues_over_time", "data_quality_issues"),
    "issue_count_by_type": ("issue_count_by_type", "data_quality_issues"),
    "issues_by_symbol": ("issues_by_symbol", "data_quality_issues"),
    "severity_breakdown": ("severity_breakdown", "data_quality_issues"),
    "recent_issues": ("recent_issues", "data_quality_issues"),
}
SINGLE_SYMBOL = {"ohlc", "spread_evolution", "volume_by_bucket", "daily_stats", "symbol_issues"}
NO_RANGE = {"daily_stats"}
NO_SYMBOLS = {"issues_by_symbol", "severity_breakdown"}


def _path(spark, d, name):
    from tape.sources import io
    for cand in (f"{d}/{name}.csv", f"{d}/{name}"):
        if io.exists(spark, cand):
            return cand
    return None


def cmd_load(spark, a):
    from tape.sources import contract, io
    for name in RAW_TABLES:
        p = _path(spark, a.csv, name)
        if p is None:
            if name == "order_book_snapshots":
                continue
            raise io.MissingInput(f"{name}: no {name}.csv under {a.csv}")
        df = contract.read_checked(spark, name, p)
        counts = contract.write_checked(df, name, f"{a.out}/{name}", load=a.load)
        print(name, *[f"{k}={v}" for k, v in counts.items()])
        io.verify_counts(df, spark.read.parquet(f"{a.out}/{name}"), name).show(truncate=False)
        contract.load_report(spark, name, f"{a.out}/{name}").orderBy("verdict", "fault").show(100, truncate=False)


def cmd_run(spark, a):
    from tape.plans.pipeline import run_pipeline
    from tape.sources import contract, io
    raw = {}
    for name in RAW_TABLES:
        p = f"{a.raw}/{name}"
        if io.exists(spark, p):
            raw[name] = contract.good(spark, p).drop("date")
        elif name == "order_book_snapshots":
            print(f"{name}: not under {a.raw}; the book models are left out")
        else:
            raise io.MissingInput(f"{name}: not under {a.raw}")
    out = run_pipeline(spark, raw, a.out, write_raw=False)
    out["table_checks"].orderBy("test", "detail").show(200, truncate=False)
    out["issue_summary"].show(truncate=False)
    out["issue_rate"].show(truncate=False)


def cmd_report(spark, a):
    from tape.plans import reports
    fn_name, model = REPORTS[a.name]
    df = spark.read.parquet(f"{a.out}/{model}")
    fn = getattr(reports, fn_name)
    kw = {}
    if a.name in SINGLE_SYMBOL:
        if not a.symbol or len(a.symbol) != 1:
            raise SystemExit(f"{a.name} needs exactly one --symbol")
        args = [df, a.symbol[0]]
    else:
        args = [df]
        if a.name not in NO_SYMBOLS:
            kw["symbols"] = a.symbol or None
    if a.name not in NO_RANGE:
        kw.update(start=a.start, end=a.end)
    if model == "data_quality_issues" and a.name != "symbol_issues":
        kw["time_col"] = a.time_col
    res = fn(*args, **kw)
    if a.save:
        res.write.mode("overwrite").parquet(a.save)
    else:
        res.show(a.rows, truncate=False)


def main(argv=None):
    ap = argparse.ArgumentParser(prog="python -m tape")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load")
    p.add_argument("--csv", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--load", default="csv", help="name of the input: loading it again replaces its quarantined rows")
    p = sub.add_parser("run")
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("report")
    p.add_argument("name", choices=sorted(REPORTS))
    p.add_argument("--out", required=True, help="folder written by 'run'")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--symbol", action="append")
    p.add_argument("--time-col", default="detected_at")
    p.add_argument("--rows", type=int, default=50)
    p.add_argument("--save")
    a = ap.parse_args(argv)
    spark = get_session(app=f"tape-{a.cmd}")
    {"load": cmd_load, "run": cmd_run, "report": cmd_report}[a.cmd](spark, a)


if __name__ == "__main__":
    sys.exit(main())
