"""Contracts at load, checks during passes, declared tables, single-symbol reads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tape.operators import checks, marts, sketches
from tape.plans import catalog as C
from tape.plans.pipeline import run_pipeline
from tape.sources import contract, io, tables
from tests.conftest import SF_SMALL
from tests.util import BOOK_SCHEMA, TRADES_SCHEMA, bag, rows, trade

HEADER = "symbol,timestamp,trade_price,trade_size,exchange,trade_condition,data_quality_flag\n"
GOOD = "A,2024-01-02 10:00:00.000001,1.5,100,NYSE,@,OK\n"
FAULTY = {
    "A,2024-01-02 10:00:00.000001,abc,100,NYSE,@,OK\n": ["malformed"],
    "A,2024-01-02 10:00:00.000001,1.5\n": ["malformed"],
    "A,2024-01-02 10:00:00.000001,1.5,100,NYSE,@,OK,more\n": ["malformed"],
    "A,never,1.5,100,NYSE,@,OK\n": ["malformed"],
    ",2024-01-02 10:00:00.000001,1.5,100,NYSE,@,OK\n": ["null symbol"],
    "A,,,100,NYSE,@,OK\n": ["null timestamp", "null trade_price"],
    "A,2024-01-02 10:00:00.000001,1.5,-1,NYSE,@,NO\n": ["domain trade_size", "domain data_quality_flag"],
    "A,2024-01-02 10:00:00.000001,1.5,4294967296,NYSE,@,OK\n": ["domain trade_size"],
}


def csv(tmp_path, name, lines, header=HEADER):
    path = tmp_path / name
    path.write_text(header + "".join(lines))
    return str(path)


def test_every_row_is_good_or_bad_with_its_faults(spark, tmp_path):
    no_flag = "B,2024-01-03 10:00:00.000001,2.5,100,NYSE,@,\n"
    path = csv(tmp_path, "t.csv", [GOOD, *FAULTY, no_flag])
    out = str(tmp_path / "out")
    counts = contract.write_checked(contract.read_checked(spark, "trades", path), "trades", out, load="one")
    assert counts == {"rows_in": 10, "rows_good": 2, "rows_bad": 8}
    good = rows(contract.good(spark, out))
    assert sorted((r["symbol"], r["data_quality_flag"], r["date"]) for r in good) == [("A", "OK", dt.date(2024, 1, 2)), ("B", "OK", dt.date(2024, 1, 3))]
    bad = contract.quarantine(spark, out).collect()
    assert sorted(tuple(r.faults) for r in bad) == sorted(tuple(f) for f in FAULTY.values())
    assert {r.record for r in bad if r.faults == ["malformed"]} == {k.strip() for k, f in FAULTY.items() if f == ["malformed"]}
    report = {(r["verdict"], r["fault"]): r["n_rows"] for r in rows(contract.load_report(spark, "trades", out))}
    assert report["good", ""] == 2 and report["bad", "any"] == 8 and report["bad", "malformed"] == 4


def test_loads_replace_their_own_rows_only(spark, tmp_path):
    out = str(tmp_path / "out")
    faulty = list(FAULTY)
    first, second = csv(tmp_path, "a.csv", [GOOD, *faulty[:3]]), csv(tmp_path, "b.csv", [GOOD.replace("01-02", "01-05"), faulty[4]])

    def load(path, name):
        return contract.write_checked(contract.read_checked(spark, "trades", path), "trades", out, load=name)

    load(first, "a"), load(second, "b"), load(first, "a")
    assert contract.good(spark, out).count() == 2
    assert {r["load"]: r["count"] for r in contract.quarantine(spark, out).groupBy("load").count().collect()} == {"a": 3, "b": 1}
    mended = csv(tmp_path, "c.csv", [GOOD])
    assert load(mended, "a") == {"rows_in": 1, "rows_good": 1, "rows_bad": 0}
    assert {r["load"] for r in contract.quarantine(spark, out).collect()} == {"b"} and contract.good(spark, out).count() == 2


def test_headers_and_columns_must_be_the_declared_ones(spark, tmp_path):
    path = csv(tmp_path, "t.csv", [GOOD], HEADER.replace("trade_price", "price"))
    with pytest.raises(Exception, match="(?i)header"):
        contract.read_checked(spark, "trades", path).collect()
    with pytest.raises(ValueError, match="missing columns"):
        contract.judged(spark.createDataFrame([("A",)], "symbol string"), "trades")
    with pytest.raises(io.MissingInput):
        contract.read_checked(spark, "trades", str(tmp_path / "nothing.csv"))


def test_book_arrays_are_judged(spark, tmp_path):
    header = "symbol,timestamp,bid_prices,bid_sizes,ask_prices,ask_sizes,mid_price,weighted_mid,book_imbalance,data_quality_flag\n"
    row = 'A,2024-01-02 10:00:00.000001,"{}","{}","[1.2]","[5]",1.1,1.1,0.0,OK\n'
    path = csv(tmp_path, "b.csv", [row.format("[1.0]", "[5]"), row.format("[1.0]", "[-5]"), row.format("no array", "[5]"), row.format("[1.0,null]", "[5,6]")], header)
    out = str(tmp_path / "out")
    assert contract.write_checked(contract.read_checked(spark, "order_book_snapshots", path), "order_book_snapshots", out, load="b")["rows_good"] == 1
    assert sorted(tuple(r.faults) for r in contract.quarantine(spark, out).collect()) == [("domain bid_prices",), ("domain bid_sizes",), ("malformed",)]


def test_an_empty_table_loads(spark, tmp_path):
    out = str(tmp_path / "out")
    empty = spark.createDataFrame([], TRADES_SCHEMA)
    assert contract.write_checked(empty, "trades", out, load="none") == {"rows_in": 0, "rows_good": 0, "rows_bad": 0}
    schema = contract.placed(empty, "trades").schema
    assert contract.good(spark, out, schema).count() == contract.load_report(spark, "trades", out, schema).count() == 0


def test_pipeline_keeps_bad_rows_out_of_the_models(spark, tmp_path):
    quotes = C.raw_quotes(spark, SF_SMALL)
    trades = C.raw_trades(spark, SF_SMALL)
    broken = trades.where("tick_id % 10 = 3").withColumn("trade_size", F.lit(-5).cast("long"))
    clean = trades.where("tick_id % 10 <> 3")
    as_of = dt.datetime(2024, 1, 20)
    run = run_pipeline(spark, {"trades": clean.unionByName(broken), "quotes": quotes}, str(tmp_path / "run"), as_of=as_of, tie=["tick_id"])
    report = {(r["table"], r["verdict"], r["fault"]): r["n_rows"] for r in rows(run["load_report"])}
    assert report["trades", "bad", "domain trade_size"] == broken.count() and report["trades", "good", ""] == clean.count()
    want = run_pipeline(spark, {"trades": clean, "quotes": quotes}, str(tmp_path / "clean"), as_of=as_of, tie=["tick_id"])
    for name in ("int_vwap", "mart_daily_summary", "data_quality_issues", "table_checks"):
        assert bag(rows(run[name])) == bag(rows(want[name]))
    # the counts that came with the writes are those of passes of their own
    found = {(r["test"], r["detail"]): r["failing_rows"] for r in rows(run["table_checks"])}
    late = checks.future_rows(C.quotes(spark, SF_SMALL), as_of).count()
    assert late > 0 and found["no_future:stg_quotes", ""] == late
    assert found["vwap_within_range", ""] == checks.vwap_out_of_range(want["mart_daily_summary"]).count()
    assert found["not_null:int_vwap", "vwap"] == 0 and found["accepted_values:stg_trades.data_quality_flag", ""] == 0


def test_watch_counts_what_queries_count(spark):
    data = [trade("A", "2024-01-02 10:00:00", 1, 1), (None, *trade("A", "2024-01-02 10:00:01", 1, 1, flag="ODD")[1:]), trade("B", "2030-01-01 00:00:00", 1, 1, flag="ODD")]
    df = spark.createDataFrame(data, TRADES_SCHEMA)
    watch = checks.Watch(dt.datetime(2025, 1, 1))
    watch.add("trades", df, {"data_quality_flag": ["OK"]}, future=True).write.format("noop").mode("overwrite").save()
    found = {(t, d): n for t, d, n in watch.failing()}
    assert found["not_null:trades", "symbol"] == 1 and found["not_null:trades", "trade_price"] == 0
    assert found["accepted_values:trades.data_quality_flag", ""] == 2 and found["no_future:trades", ""] == 1


def explained(spark, df):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_declared_tables_join_by_day_without_an_exchange(spark, tmp_path):
    names = {}
    for model, df in (("stg_trades", C.trades(spark, SF_SMALL)), ("stg_quotes", C.quotes(spark, SF_SMALL))):
        names[model] = tables.unique(model)
        tables.declare(spark, model, names[model], str(tmp_path / model), extra="tick_id BIGINT", buckets=4)
        tables.fill(df.drop("data_quality_flag") if model == "stg_quotes" else df, model, names[model])
    t, q = spark.table(names["stg_trades"]), spark.table(names["stg_quotes"])
    assert {r[0] for r in q.select("data_quality_flag").distinct().collect()} == {"OK"}
    trade_days = marts.daily_trade_stats(t, ["tick_id"])
    quote_days = q.groupBy("symbol", F.col("quote_date").alias("trade_date")).agg(F.count("*").alias("n"))
    joined = trade_days.hint("merge").join(quote_days.hint("merge"), ["symbol", "trade_date"], "left")
    plan = explained(spark, joined)
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan and "Exchange" not in plan
    assert bag(rows(trade_days)) == bag(rows(marts.daily_trade_stats(C.trades(spark, SF_SMALL), ["tick_id"])))


def test_declared_tables_refuse_nulls(spark, tmp_path):
    name = tables.unique("t")
    tables.declare(spark, "stg_trades", name, str(tmp_path / "t"), buckets=2)
    df = C.trades(spark, SF_SMALL).drop("tick_id")
    with pytest.raises(Exception, match="symbol is NULL"):
        tables.fill(df.withColumn("symbol", F.when(F.col("trade_size") > 5, F.col("symbol"))), "stg_trades", name)
    assert spark.table(name).count() == 0


def rows_scanned(df):
    """Rows that the only scan of ``df`` hands on, after Parquet has skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaf = plan.collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_one_symbol_reads_few_row_groups(spark, tmp_path):
    n = 200_000
    df = spark.range(n).select(F.format_string("S%04d", F.col("id") % 2000 * 2).alias("symbol"), (F.timestamp_millis("id")).cast("timestamp_ntz").alias("timestamp"),
                               F.rand(1).alias("trade_price"), F.to_date(F.lit("2024-01-02")).alias("date"))
    path = str(tmp_path / "t")
    before = spark.sparkContext._jsc.hadoopConfiguration().get("parquet.block.size")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(64 * 1024))
    try:
        io.write_table(df, path, date_col="date", partitions=2)
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        conf.set("parquet.block.size", before) if before else conf.unset("parquet.block.size")
    table = spark.read.parquet(path)
    assert table.count() == n
    # row-group statistics: a few groups of one symbol's range
    one = table.where("symbol = 'S0100'")
    assert one.count() == 100 and rows_scanned(table.where("symbol = 'S0100'")) < n / 10
    # bloom filters: inside the range, but nowhere
    assert rows_scanned(table.where("symbol = 'S0101'")) == 0


def test_sketches_merge_to_any_grouping(spark):
    q = C.quotes(spark, "/root/testdata/sf0.01")
    small = sketches.minute_sketches(q)
    for keys in (["quote_date"], ["symbol"]):
        answers = sketches.roll_up(small, keys, [0.5, 0.95], ["median", "p95"])
        errors = rows(sketches.rank_errors(q, keys, "spread_bps", answers, [0.5, 0.95], ["median", "p95"]))
        assert errors and all(r["error_median"] <= sketches.RANK_ERROR and r["error_p95"] <= sketches.RANK_ERROR for r in errors)


def test_book_schema_is_the_declared_one():
    assert {"bid_prices", "ask_sizes"} <= {f.name for f in BOOK_SCHEMA.fields}
