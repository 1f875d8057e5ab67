"""Summarise the physical plan of every registered query as a markdown table.

    python tools/plan_report.py [sf_dir] > /tmp/plans.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tape.plans.catalog import QUERIES  # noqa: E402
from tape.session import get_session  # noqa: E402

# queries whose function writes files or runs a stream before returning
SIDE_EFFECTS = {"csv_roundtrip", "book_csv_roundtrip", "partitioned_load", "load_quarantine", "dq_scan_slices", "chk_not_null",
                "spread_sketches", "daily_summary_declared", "symbols_by_view", "dq_outlier_range", *(k for k in QUERIES if k.startswith("batch_run")),
                "stream_vwap_bars", "stream_volume_profile", "stream_dedup", "stream_stale", "stream_checks_sink"}


def summary(plan: str) -> dict:
    ops = re.findall(r"^[\s:+\-*()0-9]*([A-Za-z]+)", plan, re.M)
    def n(name):
        return sum(1 for o in ops if o == name)
    aggs = sorted({o for o in ops if o.endswith("Aggregate")})
    joins = sorted({o for o in ops if o.endswith("Join")})
    return {"exchanges": n("Exchange") + n("BroadcastExchange"), "scans": n("FileScan"),
            "aggregates": ", ".join(aggs) or "-", "joins": ", ".join(joins) or "-",
            "windows": n("Window"), "generate": n("Generate")}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16, extra={"spark.ui.showConsoleProgress": "false"})
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # the static plan, before runtime re-planning
    print("| query | exchanges | input scans | aggregates | joins | windows |")
    print("| --- | --- | --- | --- | --- | --- |")
    for k, fn in QUERIES.items():
        if k in SIDE_EFFECTS:
            print(f"| `{k}` | (writes / streams; see module) | | | | |")
            continue
        s = summary(fn(spark, sf)._jdf.queryExecution().executedPlan().toString())
        print(f"| `{k}` | {s['exchanges']} | {s['scans']} | {s['aggregates']} | {s['joins']} | {s['windows']} |")


if __name__ == "__main__":
    main()
