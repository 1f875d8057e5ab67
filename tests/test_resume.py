"""Scans in slices find what one scan finds."""

import datetime as dt

from pyspark.sql import functions as F

from tape.operators import quality, resume
from tape.plans import catalog as C
from tape.schemas import ISSUE_COLUMNS
from tests.conftest import SF_SMALL
from tests.util import QUOTES_SCHEMA, TRADES_SCHEMA, bag, quote, rows, trade

AS_OF = dt.datetime(2025, 1, 1)


def sliced(spark, t, q, base, days, repeat=()):
    for run, (a, b) in enumerate(days, 1):
        mine = F.to_date("timestamp").between(F.lit(a), F.lit(b))
        for _ in range(2 if run in repeat else 1):
            resume.scan_slice(spark, t.where(mine), q.where(mine), base, run, as_of=AS_OF, tie=["tick_id"], block_rows=1000)
    return resume.findings(spark, base, q.schema["timestamp"].dataType).select(*ISSUE_COLUMNS)


def test_days_find_what_the_whole_finds(spark, tmp_path):
    t, q = C.raw_trades(spark, SF_SMALL), C.raw_quotes(spark, SF_SMALL)
    days = [(dt.date(2024, 1, 1), dt.date(2024, 1, 4)), (dt.date(2024, 1, 5), dt.date(2024, 1, 5)), (dt.date(2024, 1, 6), dt.date(2024, 1, 19)), (dt.date(2024, 1, 20), dt.date(2024, 3, 1))]
    want = rows(quality.scan(t, q, as_of=AS_OF, tie=["tick_id"]).select(*ISSUE_COLUMNS))
    got = rows(sliced(spark, t, q, str(tmp_path / "s"), days, repeat=(2,)))
    assert len(want) > 100 and bag(got) == bag(want)


def test_frames_reach_back_over_slices(spark, tmp_path):
    """An outlier on a later day is one by the trades of the day before; a gap is
    measured from the last quote of an earlier slice, whatever the day between."""
    base = [trade("A", f"2024-01-02 10:{i // 60:02d}:{i % 60:02d}", 100 + i % 3, 10, tid=i) for i in range(1200)]
    t = spark.createDataFrame([*base, trade("A", "2024-01-04 10:00:00", 250, 10, tid=2000), trade("N", "2024-01-04 10:00:00", 250, 10, tid=2001)], TRADES_SCHEMA)
    q = spark.createDataFrame([quote("A", "2024-01-02 20:59:59", 1, 2, tid=1), quote("A", "2024-01-04 14:00:00", 1, 2, tid=2), quote("A", "2024-01-04 14:00:01", 1, 2, tid=3)], QUOTES_SCHEMA)
    days = [(dt.date(2024, 1, d), dt.date(2024, 1, d)) for d in (2, 3, 4)]
    path = str(tmp_path / "s")
    got = rows(sliced(spark, t, q, path, days))
    assert bag(got) == bag(rows(quality.scan(t, q, as_of=AS_OF, tie=["tick_id"]).select(*ISSUE_COLUMNS)))
    assert sorted((r["issue_type"], r["event_time"].day) for r in got) == [("PRICE_OUTLIER", 4), ("STALE_QUOTE", 4)]
    # a run reads no history: the state holds 999 trades and one quote of a symbol
    kept = spark.read.parquet(f"{path}/state/run=3/trades")
    assert {r["symbol"]: r["count"] for r in kept.groupBy("symbol").count().collect()} == {"A": 999, "N": 1}
    assert spark.read.parquet(f"{path}/state/run=3/quotes").count() == 1


def test_sizes_by_blocks_equal_plain_medians(spark):
    import numpy as np

    from tape.operators import sizes
    rng = np.random.default_rng(1)
    data = [(s, dt.datetime(2024, 1, 2, 10) + dt.timedelta(seconds=int(i // 3)), int(i), None if i % 17 == 0 else int(rng.integers(1, 9)) * (90 if i % 40 == 3 else 1))
            for s in ("A", None) for i in range(260)] + [("ONE", dt.datetime(2024, 1, 2), 1, 5), ("NONE", dt.datetime(2024, 1, 2), 1, None)]
    t = spark.createDataFrame(data, "symbol string, timestamp timestamp_ntz, tick_id long, trade_size long")
    got = {(r["symbol"], r["tick_id"]): (r["rolling_median"], r["rolling_mad"], r["is_size_outlier"]) for r in rows(sizes.size_outliers(t, rows=50, tie=["tick_id"], block_rows=60))}
    assert len(got) == len(data)
    for s in ("A", None, "ONE", "NONE"):
        own = [d for d in data if d[0] == s]
        for i, (_, _, tick, size) in enumerate(own):
            frame = [d[3] for d in own[max(0, i - 49):i + 1] if d[3] is not None]
            if not frame:
                assert got[s, tick] == (None, None, False)
                continue
            median = float(np.median(frame))
            mad = float(np.median([abs(x - median) for x in frame]))
            out = size is not None and mad > 0 and abs(size - median) > 6.0 * 1.4826 * mad
            assert got[s, tick] == (median, mad, out)
