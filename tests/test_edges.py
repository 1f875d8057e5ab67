"""Hand-made edge rows (FIXTURES §3)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tape.operators import bars, book, marts, quality, staging
from tests.util import BOOK_SCHEMA, QUOTES_SCHEMA, TRADES_SCHEMA, quote, rows, trade

AS_OF = dt.datetime(2025, 1, 1)


def T(spark, data):
    return spark.createDataFrame(data, TRADES_SCHEMA)


def Q(spark, data):
    return spark.createDataFrame(data, QUOTES_SCHEMA)


def test_zero_price_dropped_zero_size_kept(spark):
    t = T(spark, [trade("A", "2024-01-02 15:00:00", 0, 10, tid=1),
                  trade("A", "2024-01-02 15:00:01", 10, 0, tid=2)])
    out = rows(staging.stg_trades(t))
    assert len(out) == 1 and out[0]["trade_size"] == 0 and out[0]["trade_notional"] == 0.0


def test_all_sizes_zero_gives_null_vwap(spark):
    t = T(spark, [trade("A", "2024-01-02 15:00:00", 10, 0, tid=1),
                  trade("A", "2024-01-02 15:00:10", 11, 0, tid=2)])
    s = staging.stg_trades(t)
    assert rows(bars.vwap_bars(s))[0]["vwap"] is None
    d = rows(marts.daily_trade_stats(s))[0]
    assert d["day_vwap"] is None and d["trade_count"] == 2


def test_zero_side_quote_dropped_and_crossed_is_negative(spark):
    q = Q(spark, [quote("A", "2024-01-02 15:00:00", 0, 10, tid=1),
                  quote("A", "2024-01-02 15:00:01", 10.02, 10.00, tid=2)])
    out = rows(staging.stg_quotes(q))
    assert len(out) == 1 and out[0]["spread_bps"] < 0
    found = rows(quality.crossed_spreads(q, AS_OF))
    assert len(found) == 1 and found[0]["severity"] == "CRITICAL"
    assert found[0]["details"] == "bid=10.0200 ask=10.0000 spread=0.0200"


def test_zero_size_quote_already_logged_is_not_added_again(spark):
    q = Q(spark, [quote("A", "2024-01-02 15:00:00", 10, 10.1, bs=0, tid=1)])
    first = quality.zero_size_quotes(q, AS_OF)
    assert first.count() == 1
    assert quality.new_findings(quality.zero_size_quotes(q, AS_OF), first).count() == 0


def _stale(spark, times, **kw):
    q = Q(spark, [quote("A", t, 10, 10.1, tid=i) for i, t in enumerate(times)])
    return rows(quality.stale_quotes(q, tie=["tick_id"], as_of=AS_OF, **kw))


def test_single_quote_has_no_gap(spark):
    assert _stale(spark, ["2024-01-02 15:00:00"]) == []


def test_gap_threshold_is_strict(spark):
    assert _stale(spark, ["2024-01-02 15:00:00", "2024-01-02 15:00:05"]) == []
    out = _stale(spark, ["2024-01-02 15:00:00", "2024-01-02 15:00:05.001"])
    assert len(out) == 1 and out[0]["details"] == "gap_seconds=5.00" and out[0]["gap_us"] == 5_001_000


def test_day_boundary_gap_and_reset_daily(spark):
    times = ["2024-01-02 20:59:00", "2024-01-03 14:30:00"]
    for rank in ("time", "range"):
        assert len(_stale(spark, times, rank=rank, block_rows=1)) == 1
        assert _stale(spark, times, reset_daily=True, rank=rank, block_rows=1) == []


def _outliers(spark, prices, rank="time"):
    t = T(spark, [trade("A", f"2024-01-02 15:{i // 60:02d}:{i % 60:02d}", p, 1, tid=i)
                  for i, p in enumerate(prices)])
    return rows(quality.price_outliers(t, tie=["tick_id"], rank=rank, block_rows=1000, as_of=AS_OF))


def test_constant_series_has_no_outlier(spark):
    assert _outliers(spark, [10.0] * 30) == []
    assert _outliers(spark, [10.0] * 30, rank="range") == []


def test_outlier_needs_enough_history(spark):
    # z ≤ √(n−1): 8 equal ticks and a jump (n = 9) cannot exceed 3; 10 + jump (n = 11) gives √10
    assert _outliers(spark, [10.0] * 8 + [20.0]) == []
    for rank in ("time", "range"):
        out = _outliers(spark, [10.0] * 10 + [20.0], rank=rank)
        assert len(out) == 1 and math.isclose(out[0]["z_score"], math.sqrt(10), rel_tol=1e-9)


def _book(spark, bid_p, bid_s, ask_p, ask_s, flag="OK"):
    return spark.createDataFrame([("A", dt.datetime(2024, 1, 2, 15, 0, 0), bid_p, bid_s, ask_p, ask_s, flag, 1)],
                                 BOOK_SCHEMA)


def test_missing_levels_count_as_zero_depth_but_keep_top_of_book(spark):
    b = staging.enrich_book(_book(spark, [99.99, 99.98] + [0.0] * 8, [100, 200] + [0] * 8,
                                  [100.01, 100.02] + [0.0] * 8, [300, 400] + [0] * 8, "MISSING_LEVELS"))
    for exploded in (False, True):
        r = rows(book.order_book_depth(b, exploded=exploded))[0]
        assert r["avg_depth_bid_5bps"] == 0 and r["avg_depth_ask_10bps"] == 0
        assert r["avg_tob_bid_size"] == 100 and r["avg_tob_ask_size"] == 300
        assert r["depth_imbalance_5bps"] is None


def test_empty_book_weighted_mid_is_mid_and_imbalance_zero(spark):
    b = rows(staging.enrich_book(_book(spark, [10.0, 9.9], [0, 0], [10.2, 10.3], [0, 0])))[0]
    assert b["weighted_mid"] == b["mid_price"] == 10.1 and b["book_imbalance"] == 0.0


def test_day_without_quotes_keeps_trade_issue_count(spark):
    t = staging.stg_trades(T(spark, [trade("A", "2024-01-02 15:00:00", 10, 1, "PRICE_OUTLIER", 1),
                                     trade("B", "2024-01-02 15:00:00", 10, 1, tid=2)]), keep=["tick_id"])
    q = staging.stg_quotes(Q(spark, [quote("B", "2024-01-02 15:00:00", 9.9, 10.1, tid=3)]))
    out = {r["symbol"]: r for r in rows(marts.daily_summary(t, q, tie=["tick_id"]))}
    assert out["A"]["total_quality_issues"] == 1 and out["A"]["quote_count"] == 0
    assert out["A"]["avg_spread_bps"] is None and out["B"]["quote_count"] == 1


def test_same_microsecond_trades_break_ties_by_key(spark):
    s = staging.stg_trades(T(spark, [trade("A", "2024-01-02 15:00:00", 11, 1, tid=2),
                                     trade("A", "2024-01-02 15:00:00", 10, 1, tid=1),
                                     trade("A", "2024-01-02 15:00:00", 12, 1, tid=3)]), keep=["tick_id"])
    r = rows(bars.vwap_bars(s, tie=["tick_id"]))[0]
    assert (r["open"], r["close"]) == (10.0, 12.0)


def test_loading_twice_does_not_duplicate(spark, tmp_path):
    from tape.sources import io
    s = staging.stg_trades(T(spark, [trade("A", "2024-01-02 15:00:00", 10, 1, tid=1),
                                     trade("A", "2024-01-03 15:00:00", 10, 1, tid=2)]))
    p = str(tmp_path / "t")
    io.write_table(s, p, date_col="trade_date")
    io.write_table(s.where(F.col("trade_date") == dt.date(2024, 1, 3)), p, date_col="trade_date")
    assert spark.read.parquet(p).count() == 2


def test_missing_input_is_reported(spark, tmp_path):
    import pytest
    from tape.sources import io
    with pytest.raises(io.MissingInput):
        io.read_csv(spark, "trades", str(tmp_path / "nope.csv"))


def test_packed_order_key_handles_extreme_tie_keys(spark):
    big, small = 9_223_372_036_854_775_807, -9_223_372_036_854_775_807
    s = staging.stg_trades(T(spark, [trade("A", "2024-01-02 15:00:00", 11, 1, tid=big),
                                     trade("A", "2024-01-02 15:00:00", 10, 1, tid=small),
                                     trade("A", "2024-01-02 15:00:00.000001", 12, 1, tid=small),
                                     trade("A", "2024-01-02 14:59:59.999999", 9, 1, tid=big)]), keep=["tick_id"])
    r = rows(bars.vwap_bars(s, tie=["tick_id"]))
    by_min = {x["minute_bucket"].minute: x for x in r}
    assert (by_min[0]["open"], by_min[0]["close"]) == (10.0, 12.0)
    d = rows(marts.daily_trade_stats(s, tie=["tick_id"]))[0]
    assert (d["open_price"], d["close_price"]) == (9.0, 12.0)


def test_conform_rejects_missing_columns_and_casts(spark):
    import pytest
    from tape.sources import io
    t = T(spark, [trade("A", "2024-01-02 15:00:00", 10, 1, tid=1)])
    with pytest.raises(ValueError):
        io.conform(t.drop("exchange"), "trades")
    out = io.conform(t, "trades")
    assert out.columns == ["symbol", "timestamp", "trade_price", "trade_size", "exchange", "trade_condition",
                           "data_quality_flag"]


def test_csv_malformed_row_fails_fast(spark, tmp_path):
    import pytest
    from tape.sources import io
    p = tmp_path / "trades.csv"
    p.write_text("symbol,timestamp,trade_price,trade_size,exchange,trade_condition,data_quality_flag\n"
                 "A,2024-01-02 15:00:00.000001,10.5,100,NYSE,@,OK\n"
                 "A,2024-01-02 15:00:01.000000,not-a-price,100,NYSE,@,OK\n")
    with pytest.raises(Exception):
        io.read_csv(spark, "trades", str(p)).collect()
    p.write_text("symbol,timestamp,trade_price,trade_size,exchange,trade_condition,data_quality_flag\n"
                 "A,2024-01-02 15:00:00.000001,10.5,100,NYSE,@,\n")
    r = io.read_csv(spark, "trades", str(p)).collect()[0]
    assert r["data_quality_flag"] == "OK" and r["timestamp"].microsecond == 1


def test_unrolled_level_check_matches_exists(spark):
    from tape.functions import book as B
    df = spark.createDataFrame([([1.0, 0.0],), ([1.0, None],), ([1.0, 2.0],), ([],), (None,),
                                ([float(i + 1) for i in range(12)] + [0.0],)], "p array<double>")
    got = [r[0] for r in df.select(B.any_level_at_most("p")).collect()]
    exp = [r[0] for r in df.selectExpr("exists(p, x -> x <= 0D)").collect()]
    assert got == exp
