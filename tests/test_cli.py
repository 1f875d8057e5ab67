"""The command line: CSV load → pipeline run → report, in-process."""

from pyspark.sql import functions as F

from tape.__main__ import main
from tape.plans import catalog as C
from tape.sources import io
from tests.conftest import SF_SMALL


def test_load_run_report(spark, tmp_path):
    csv = tmp_path / "csv"
    as_ts = {"timestamp": F.col("timestamp").cast("timestamp")}
    io.write_csv(io.conform(C.raw_trades(spark, SF_SMALL).withColumns(as_ts), "trades"), str(csv / "trades"))
    io.write_csv(io.conform(C.raw_quotes(spark, SF_SMALL).withColumns(as_ts), "quotes"), str(csv / "quotes"))
    io.write_csv(io.conform(C.book(spark, SF_SMALL).withColumns(as_ts), "order_book_snapshots"),
                 str(csv / "order_book_snapshots"))
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    main(["load", "--csv", str(csv), "--out", raw])
    assert spark.read.parquet(f"{raw}/trades").count() == C.raw_trades(spark, SF_SMALL).count()
    main(["run", "--raw", raw, "--out", out])
    assert spark.read.parquet(f"{out}/mart_daily_summary").count() == C.daily(spark, SF_SMALL).count()
    assert spark.read.parquet(f"{out}/int_order_book_depth").count() > 0
    main(["report", "volume_by_symbol", "--out", out, "--save", str(tmp_path / "r1")])
    r1 = spark.read.parquet(str(tmp_path / "r1"))
    assert r1.count() == 25 and r1.agg(F.sum("volume")).first()[0] > 0
    main(["report", "ohlc", "--out", out, "--symbol", "click_2", "--start", "2024-01-03 00:00:00",
          "--save", str(tmp_path / "r2")])
    assert spark.read.parquet(str(tmp_path / "r2")).count() > 0
    main(["report", "issue_count_by_type", "--out", out, "--time-col", "event_time", "--save", str(tmp_path / "r3")])
    assert spark.read.parquet(str(tmp_path / "r3")).count() > 0


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_RUNS="1", BENCH_CPUS="2", BENCH_DRIVER_MEMORY="1g")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py"), "int_vwap", "dq_scan"], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and set(d["queries"]) == {"int_vwap", "dq_scan"} and d["value"] > 0
