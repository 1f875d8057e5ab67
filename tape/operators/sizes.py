"""Trades of unusual size (Q12 ``SIZE_OUTLIER``).

A trade's size is compared with the median of the symbol's last 1000 trades (its
own included) in units of their median absolute deviation, which a few huge trades
do not move.  Rows come in blocks with the 999 rows before them
(``windows.with_halo``), so a task holds one block of a symbol however many trades
it has; inside a block all frames' order statistics are selected together (numpy
partitions of a strided view, ``STEP`` rows at a time).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tape.operators import windows

#: Frames that are selected at once: 8 bytes × 1000 × STEP in memory.
STEP = 512
#: A normal distribution's deviation in units of its median absolute deviation.
NORMAL = 1.4826


def frame_medians(frames: np.ndarray) -> np.ndarray:
    """Median of each row, NaN left out; NaN for a row of nothing else."""
    width = frames.shape[1]
    n = width - np.isnan(frames).sum(1)
    whole = n == width
    out = np.full(len(frames), np.nan)
    if whole.any():
        mid = [(width - 1) // 2, width // 2]
        out[whole] = np.partition(frames[whole], mid, axis=1)[:, mid].mean(1)
    some = ~whole & (n > 0)
    if some.any():  # the first frames of a symbol, and those with NULLs: NaN sorts last
        rows, k = np.sort(frames[some], axis=1), n[some]
        at = np.arange(len(rows))
        out[some] = (rows[at, (k - 1) // 2] + rows[at, k // 2]) / 2
    return out


def rolling_median_mad(values: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Median and median absolute deviation over the last ``rows`` values."""
    padded = np.concatenate([np.full(rows - 1, np.nan), values])
    frames = np.lib.stride_tricks.sliding_window_view(padded, rows)
    median, mad = np.empty(len(values)), np.empty(len(values))
    for i in range(0, len(values), STEP):
        part = frames[i:i + STEP]
        median[i:i + STEP] = m = frame_medians(part)
        mad[i:i + STEP] = frame_medians(np.abs(part - m[:, None]))
    return median, mad


def with_rolling_size(trades: DataFrame, rows: int = 1000, tie: Sequence[str] = (), block_rows: int = 20_000,
                      value: str = "trade_size", rank: str = "time") -> DataFrame:
    """``trades`` with ``rolling_median`` and ``rolling_mad`` of ``value``."""
    halo = rows - 1
    x = windows.with_halo(windows._ranked(trades, ["symbol"], ["timestamp", *tie], windows.COARSE_SECONDS, "timestamp", rank),
                          ["symbol"], halo, max(block_rows, halo))
    columns = trades.columns
    kept = StructType([*trades.schema.fields, StructField("rolling_median", DoubleType()), StructField("rolling_mad", DoubleType())])

    def block(table: pa.Table) -> pa.Table:
        table = table.sort_by("_rn")
        sizes = table.column(value).cast(pa.float64()).to_numpy()
        median, mad = rolling_median_mad(sizes, rows)
        own = ~table.column("_halo").to_numpy()
        out = table.select(columns).filter(pa.array(own))
        for name, found in (("rolling_median", median), ("rolling_mad", mad)):
            out = out.append_column(name, pa.array(found[own], from_pandas=True))
        return out

    return x.groupBy("symbol", "_blk").applyInArrow(block, kept)


def size_outliers(trades: DataFrame, limit: float = 6.0, rows: int = 1000, tie: Sequence[str] = (), block_rows: int = 20_000) -> DataFrame:
    """``trades`` with ``rolling_median``, ``rolling_mad`` and ``is_size_outlier``:
    more than ``limit`` deviations from the median.  Where the deviation is 0
    (one size throughout) nothing is an outlier; NULL sizes are none."""
    t = with_rolling_size(trades, rows, tie, block_rows)
    far = F.abs(F.col("trade_size") - F.col("rolling_median")) > F.lit(limit * NORMAL) * F.col("rolling_mad")
    return t.withColumn("is_size_outlier", F.coalesce((F.col("rolling_mad") > 0) & far, F.lit(False)))
