"""Two plans, one answer; plus model invariants."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from tape.operators import asof, bars, book, quality
from tape.plans import catalog as C
from tests.conftest import SF_MID, SF_SMALL
from tests.util import bag, rows, sliding_mean_std, sliding_previous

AS_OF = dt.datetime(2025, 1, 1)


def test_book_paths_agree(spark):
    b = C.book(spark, SF_MID)
    a = rows(book.order_book_depth(b, tie=["tick_id"], exploded=True))
    c = rows(book.order_book_depth(b, tie=["tick_id"]))
    assert bag(a) == bag(c)


def test_findings_agree_with_the_sliding_frame_on_lineitem(spark):
    from tape.sources import fixtures as fx
    t = fx.trades_from_lineitem(fx.table(spark, SF_MID, "lineitem"))
    order = ["timestamp", *fx.LINEITEM_TIE]
    s = sliding_mean_std(t.select("symbol", "timestamp", "trade_price", *fx.LINEITEM_TIE), "trade_price", ["symbol"], order, 1000)
    plain = rows(s.where("rolling_std > 0 and abs(trade_price - rolling_mean) / rolling_std > 3")
                 .select("symbol", F.col("timestamp").alias("event_time"), "trade_price"))
    key = ["symbol", "event_time", "trade_price"]
    assert len(plain) > 0
    for rank in ("time", "range"):
        got = rows(quality.price_outliers(t, tie=fx.LINEITEM_TIE, block_rows=1000, rank=rank, as_of=AS_OF).select(*key))
        assert bag(plain) == bag(got)
    q = t.select("symbol", "timestamp", *fx.LINEITEM_TIE)
    gap = F.unix_micros(F.col("timestamp").cast("timestamp")) - F.unix_micros(F.col("_p").cast("timestamp"))
    lag = rows(sliding_previous(q, "timestamp", ["symbol"], order, "_p").withColumn("gap_us", gap).where("gap_us > 5000000")
               .select("symbol", F.col("timestamp").alias("event_time"), "gap_us"))
    assert len(lag) > 0
    for rank, block in (("time", 37), ("range", 11)):
        got = rows(quality.stale_quotes(q, tie=fx.LINEITEM_TIE, hours=(0, 24), block_rows=block, rank=rank, as_of=AS_OF)
                   .select("symbol", "event_time", "gap_us"))
        assert bag(lag) == bag(got)


def _hard_series(spark):
    """NULL and NaN prices, a NULL symbol, NULL times, a level shift."""
    base = dt.datetime(2024, 1, 2, 14, 30)
    data = []
    for i in range(400):
        s = [None, "A", "B", "C"][i % 4]
        px = None if i < 8 or i % 37 == 0 else float("nan") if s == "B" and i == 122 else 1e9 + i % 7 if i > 250 and s == "C" else 100.0 + (i * i) % 13
        data.append((s, None if i in (3, 40, 41) else base + dt.timedelta(seconds=11 * (i // 3)), i, px))
    return spark.createDataFrame(data, "symbol string, timestamp timestamp_ntz, tick_id long, px double")


def test_windows_agree_on_nulls_nans_and_level_shifts(spark):
    from tape.operators import windows
    df = _hard_series(spark).withColumn("kept", F.create_map(F.lit("k"), F.col("tick_id")))
    order = ["timestamp", "tick_id"]
    want = {r["tick_id"]: r for r in rows(sliding_mean_std(df, "px", ["symbol"], order, 20))}
    lag = {r["tick_id"]: r["p"] for r in rows(sliding_previous(df, "px", ["symbol"], order, "p"))}
    for rank in ("time", "range"):
        got = {r["tick_id"]: r for r in rows(windows.rolling_mean_std(df, "px", ["symbol"], order, 20, block_rows=25, rank=rank))}
        assert got.keys() == want.keys()
        for k, w in want.items():
            for c in ("rolling_mean", "rolling_std"):
                a, b = w[c], got[k][c]
                assert (a is None) == (b is None) and (a is None or (a != a and b != b) or abs(a - b) <= 1e-8 * max(1.0, abs(a))), (k, c, a, b)
        back = {r["tick_id"]: r["p"] for r in rows(windows.previous(df, "px", ["symbol"], order, "p", block_rows=3, rank=rank))}
        assert {k: repr(v) for k, v in back.items()} == {k: repr(v) for k, v in lag.items()}


def test_numbering_does_not_depend_on_exchange_reuse(spark):
    from tape.operators import windows
    from tape.operators.quantiles import exact_quantiles
    from tape.sources import fixtures as fx
    t = fx.trades_from_lineitem(fx.table(spark, SF_MID, "lineitem")).withColumn("kept", F.create_map(F.lit("k"), F.lit(1)))
    t = t.withColumn("symbol", F.when(F.col("symbol") != "S01", F.col("symbol")))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        r = windows.range_row_number(t, ["symbol"], ["timestamp", *fx.LINEITEM_TIE], partitions=7)
        n = rows(r.groupBy("symbol").agg(F.count("*").alias("n"), F.min("_rn").alias("lo"), F.max("_rn").alias("hi"), F.countDistinct("_rn").alias("d")))
        assert all(x["lo"] == 1 and x["hi"] == x["n"] == x["d"] for x in n) and sum(x["n"] for x in n) == t.count()
        got = {x["symbol"]: (x["q0"], x["q1"]) for x in rows(exact_quantiles(t, ["symbol"], "trade_price", [0.5, 0.95], partitions=7))}
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    want = {x["symbol"]: tuple(x["p"]) for x in rows(t.groupBy("symbol").agg(F.percentile("trade_price", F.array(F.lit(0.5), F.lit(0.95))).alias("p")))}
    assert got == want


def test_asof_with_null_ties_symbols_and_days(spark):
    base = dt.datetime(2024, 1, 1, 9)
    q = spark.createDataFrame([(s, base + dt.timedelta(hours=5 * i), None if i % 2 else i, float(i)) for s in ("A", None) for i in range(12)],
                              "symbol string, timestamp timestamp_ntz, tie long, bid double")
    q = q.unionByName(q.withColumn("tie", F.lit(None).cast("long")).withColumn("bid", -F.col("bid")))
    t = spark.createDataFrame([(s, base + dt.timedelta(minutes=97 * i), i) for s in ("A", "Z", None) for i in range(-3, 50)],
                              "symbol string, timestamp timestamp_ntz, id long")
    for strict in (True, False):
        got = {(r["symbol"], r["id"]): r["q_timestamp"] for r in rows(asof.prevailing(t, q, ["bid"], right_tie=["tie", "bid"], strict=strict))}
        for (s, i), found in got.items():
            at = base + dt.timedelta(minutes=97 * i)
            times = [base + dt.timedelta(hours=5 * k) for k in range(12)] if s != "Z" else []
            past = [x for x in times if (x < at if strict else x <= at)]
            assert found == (max(past) if past else None)
        assert len(got) == 3 * 53


def test_asof_matches_pandas(spark):
    t = C.raw_trades(spark, SF_SMALL).select("symbol", "timestamp", "tick_id", "trade_price")
    q = C.raw_quotes(spark, SF_SMALL).select("symbol", "timestamp", "tick_id", "bid_price")
    got = rows(asof.prevailing(t, q, ["bid_price"], right_tie=["tick_id"], strict=True,
                               coarse_seconds=600))
    small = rows(asof.prevailing(t, q, ["bid_price"], right_tie=["tick_id"], strict=True))
    assert bag(got) == bag(small)
    tp = t.toPandas().sort_values("timestamp")
    qp = q.toPandas().sort_values("timestamp").rename(columns={"timestamp": "q_timestamp", "bid_price": "q_bid_price",
                                                                "tick_id": "q_tick"})
    exp = pd.merge_asof(tp, qp, left_on="timestamp", right_on="q_timestamp", by="symbol",
                        allow_exact_matches=False)
    e = {r.tick_id: r.q_bid_price for r in exp.itertuples()}
    g = {r["tick_id"]: r["q_bid_price"] for r in got}
    assert len(g) == len(e)
    for k, v in e.items():
        assert (pd.isna(v) and g[k] is None) or g[k] == v


def test_bar_invariants(spark):
    s = C.trades(spark, SF_MID)
    v = bars.vwap_bars(s, tie=["tick_id"])
    bad = v.where((F.col("low") > F.col("open")) | (F.col("open") > F.col("high")) | (F.col("low") > F.col("close"))
                  | (F.col("close") > F.col("high")) | (F.col("vwap") < F.col("low") - 1e-9)
                  | (F.col("vwap") > F.col("high") + 1e-9))
    assert bad.count() == 0
    p = bars.volume_profile(s)
    assert p.agg(F.sum("bucket_volume")).first()[0] == v.agg(F.sum("total_volume")).first()[0]


def test_book_invariants(spark):
    b = C.book(spark, SF_MID)
    assert b.where((F.col("book_imbalance") < -1) | (F.col("book_imbalance") > 1)).count() == 0
    per = book.snapshot_stats_arrays(b)
    assert per.where((F.col("depth_bid_10bps") < F.col("depth_bid_5bps"))
                     | (F.col("depth_ask_10bps") < F.col("depth_ask_5bps"))).count() == 0


def test_second_scan_adds_nothing(spark):
    t, q = C.raw_trades(spark, SF_SMALL), C.raw_quotes(spark, SF_SMALL)
    first = quality.scan(t, q, as_of=AS_OF, tie=["tick_id"])
    assert first.count() > 0
    assert quality.scan(t, q, log=first, as_of=AS_OF, tie=["tick_id"]).count() == 0


def test_distributed_quantiles_equal_percentile_on_a_hot_group(spark):
    from tape.operators.quantiles import exact_quantiles
    from tape.sources import fixtures as fx
    t = fx.trades_from_lineitem(fx.table(spark, SF_MID, "lineitem"))
    # one symbol holds most rows; many repeated values; split over 13 range partitions
    t = t.withColumn("grp", F.when(F.col("symbol") < "S20", F.lit("HOT")).otherwise(F.col("symbol")))
    t = t.withColumn("px", F.round("trade_price", 0))
    qs = [0.0, 0.25, 0.5, 0.95, 1.0]
    got = exact_quantiles(t, ["grp"], "px", qs, partitions=13)
    ref = t.groupBy("grp").agg(F.percentile("px", F.array(*[F.lit(q) for q in qs])).alias("p"))
    exp = {r["grp"]: r["p"] for r in rows(ref)}
    out = rows(got)
    assert len(out) == len(exp) == 6
    for r in out:
        assert [r[f"q{i}"] for i in range(len(qs))] == exp[r["grp"]]


def test_daily_quote_stats_equal_percentile(spark):
    from tape.operators import marts
    q = C.quotes(spark, SF_SMALL).withColumn("symbol", F.when(~F.col("symbol").endswith("_1"), F.col("symbol")))
    got = rows(marts.daily_quote_stats(q).select("symbol", "trade_date", "median_spread_bps", "p95_spread_bps"))
    want = rows(q.groupBy("symbol", F.col("quote_date").alias("trade_date")).agg(
        F.percentile("spread_bps", F.lit(0.5)).alias("median_spread_bps"), F.percentile("spread_bps", F.lit(0.95)).alias("p95_spread_bps")))
    assert len(got) > 0 and bag(got) == bag(want)
