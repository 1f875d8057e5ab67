"""Property test: the blocked window plan equals the plain window for random
series, frame sizes and block sizes (block boundaries, halo = block, …)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tape.operators import windows
from tests.util import rows, sliding_mean_std, sliding_previous

SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("timestamp", T.TimestampNTZType()),
                       T.StructField("tick_id", T.LongType()), T.StructField("px", T.DoubleType())])

series = st.lists(st.lists(st.integers(0, 50), min_size=1, max_size=40), min_size=1, max_size=3)


@settings(max_examples=int(__import__("os").environ.get("TAPE_PROPERTY_EXAMPLES", "8")), deadline=None)
@given(series=series, frame=st.integers(2, 9), extra=st.integers(0, 12), minutes=st.integers(1, 3))
def test_blocked_equals_plain(spark, series, frame, extra, minutes):
    base = dt.datetime(2024, 1, 2, 14, 30)
    data, tid = [], 0
    for s, prices in enumerate(series):
        for i, p in enumerate(prices):
            # several ticks share a timestamp; tick_id breaks the tie
            data.append((f"S{s}", base + dt.timedelta(seconds=20 * minutes * (i // 2)), tid, p / 4.0))
            tid += 1
    df = spark.createDataFrame(data, SCHEMA)
    order = ["timestamp", "tick_id"]
    block = frame - 1 + extra
    plain = {r["tick_id"]: r for r in rows(sliding_mean_std(df, "px", ["symbol"], order, frame))}
    blk = {r["tick_id"]: r for r in rows(windows.rolling_mean_std(df, "px", ["symbol"], order, frame,
                                                                  block_rows=block))}
    rng = {r["tick_id"]: r for r in rows(windows.rolling_mean_std(df, "px", ["symbol"], order, frame,
                                                                  block_rows=block, rank="range"))}
    assert plain.keys() == blk.keys() == rng.keys()
    for k, a in plain.items():
        for o in (blk, rng):
            assert abs(a["rolling_mean"] - o[k]["rolling_mean"]) < 1e-9
            assert abs(a["rolling_std"] - o[k]["rolling_std"]) < 1e-9
    lag_p = {r["tick_id"]: r["prev"] for r in rows(sliding_previous(df, "px", ["symbol"], order, "prev"))}
    lag_b = {r["tick_id"]: r["prev"] for r in rows(windows.previous(df, "px", ["symbol"], order, "prev",
                                                                    block_rows=max(1, extra)))}
    assert lag_p == lag_b
