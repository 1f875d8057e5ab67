"""Per-symbol ordered windows that scale past one task per symbol.

``Window.partitionBy('symbol')`` puts all of a symbol's history in one task:
with a few dozen symbols that is a few dozen tasks however large the data.  The
plan here, the same for every input size, keeps window partitions bounded:

1. rank rows inside (symbol, bucket of a minute)
2. rows per bucket → offsets: running counts inside each (symbol, day), plus the
   running counts of the symbol's days
3. row number per symbol = offset + local rank
4. block = (rn − 1) div B; the last ``halo`` rows of each block are copied
   into the next block, flagged, so every row sees its ``halo`` predecessors
5. window per (symbol, block) — at most B + halo rows — then drop the copies

``rank="range"`` numbers rows from a range partitioning that splits even one
huge bucket.  The partitioned rows are written once to shared storage: their
partition and position numbers are data then, and no later stage computes them
again.

Rolling mean and population σ join two partial results (count, mean, sum of
squared deviations): the frame of W rows that ends at a row is the end of one
segment of W rows and the start of the next.  Running partials forward and
backward inside segments cost O(1) a row, and nothing is subtracted, so a level
shift, a NULL or a NaN outside the frame leaves no trace.

Keys compare null-safe: NULL symbols are a group, NULL times the first bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tape.functions.time import bucket, to_date
from tape.session import materialise

#: Width of the buckets that rows are ranked in: at the 10,000 ticks a second of
#: the busiest symbols a bucket is 600,000 rows, some tens of MB.
COARSE_SECONDS = 60


def total_order(df: DataFrame, part: Sequence[str], order: Sequence[str]) -> list[str]:
    """``order`` extended with the other sortable columns, so equal keys rank
    the same way on every run — a recomputed partition after an executor loss
    numbers its rows exactly as the first attempt did.  Only rows equal in
    every column stay interchangeable, and those give identical results."""
    used = set(part) | set(order)
    rest = [f.name for f in df.schema.fields
            if f.name not in used and not isinstance(f.dataType, (T.MapType, T.BinaryType))]
    return [*order, *rest]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL equals NULL; the keys appear once."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(r, on, how).drop(*[f"_r_{k}" for k in keys])


def running_before(counts: DataFrame, part: Sequence[str], value: str, bucket_col: str, day_col: str,
                   name: str) -> DataFrame:
    """``counts`` (one row per part and bucket) with the sum of ``value`` over
    the earlier buckets of the part: inside the day, plus the days before, so
    no task holds all buckets of a symbol."""
    part = list(part)
    in_day = Window.partitionBy(*part, day_col).orderBy(bucket_col).rowsBetween(Window.unboundedPreceding, -1)
    days = counts.groupBy(*part, day_col).agg(F.sum(value).alias("_day_sum"))
    earlier = Window.partitionBy(*part).orderBy(day_col).rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(*part, day_col, F.coalesce(F.sum("_day_sum").over(earlier), F.lit(0)).alias("_days"))
    inside = counts.withColumn("_inside", F.coalesce(F.sum(value).over(in_day), F.lit(0)))
    return (null_safe_join(inside, days, [*part, day_col])
            .withColumn(name, F.col("_inside") + F.col("_days")).drop("_inside", "_days"))


def global_row_number(df: DataFrame, part: Sequence[str], order: Sequence[str],
                      coarse_seconds: int = COARSE_SECONDS, ts: str = "timestamp", name: str = "_rn") -> DataFrame:
    """1-based row number per ``part`` in ``order`` without a per-symbol sort."""
    part = list(part)
    order = total_order(df, part, order)
    d = df.withColumn("_cb", bucket(ts, coarse_seconds))
    local = d.withColumn("_rl", F.row_number().over(Window.partitionBy(*part, "_cb").orderBy(*order)))
    # Counts straight from the input: partial aggregation ships one row per
    # (symbol, bucket) per task, instead of re-running the ranking shuffle.
    counts = d.groupBy(*part, "_cb").agg(F.count(F.lit(1)).alias("_n")).withColumn("_cd", to_date("_cb"))
    offs = running_before(counts, part, "_n", "_cb", "_cd", "_off").select(*part, "_cb", "_off")
    return (null_safe_join(local, offs, [*part, "_cb"])
            .withColumn(name, F.col("_off") + F.col("_rl"))
            .drop("_cb", "_rl", "_off"))


def numbered_ranges(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted on ``keys``, with the number of its
    partition (``_pid``) and its position (``_mid``), written once."""
    r = (df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys))
    return materialise(r.sortWithinPartitions(*keys)
                       .withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()}), "ranges")


def range_row_number(df: DataFrame, part: Sequence[str], order: Sequence[str], name: str = "_rn",
                     partitions: int | None = None) -> DataFrame:
    """1-based row number per ``part`` in ``order`` that no key can skew: the
    range partitioner splits the (part, order) key space evenly, however many
    rows one symbol or one second holds.  Per (part, partition) counts and
    first positions give the offsets (a table of partitions × symbols)."""
    part = list(part)
    r = numbered_ranges(df, [*part, *total_order(df, part, order)], partitions)
    chunks = r.groupBy(*part, "_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    before = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = chunks.select(*part, "_pid", "_m0", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (null_safe_join(r, offs, [*part, "_pid"])
            .withColumn(name, F.col("_off") + (F.col("_mid") - F.col("_m0")) + 1)
            .drop("_pid", "_mid", "_m0", "_off"))


def _ranked(df, part, order, coarse_seconds, ts, rank):
    if rank == "range":
        return range_row_number(df, part, order)
    return global_row_number(df, part, order, coarse_seconds, ts)


def with_halo(ranked: DataFrame, part: Sequence[str], halo: int, block_rows: int,
              rn: str = "_rn") -> DataFrame:
    """Add ``_blk`` and copy each block's last ``halo`` rows into the next
    block with ``_halo = true``.  One pass: a tail row explodes into itself
    and its copy (no union, so the ranking is not computed twice)."""
    if block_rows < halo:
        raise ValueError("block_rows must be at least the halo")
    pos = F.pmod(F.col(rn) - 1, F.lit(block_rows))
    copies = F.when(pos >= block_rows - halo, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (ranked.withColumn("_copy", F.explode(copies))
            .withColumn("_blk", F.floor((F.col(rn) - 1) / F.lit(block_rows)).cast("long") + F.col("_copy"))
            .withColumn("_halo", F.col("_copy") == 1)
            .drop("_copy"))


def _partials(value: str, w) -> Column:
    """struct(n, mean, m2) of the non-NULL values in a frame."""
    return F.struct(F.count(value).over(w).cast("double").alias("n"), F.coalesce(F.avg(value).over(w), F.lit(0.0)).alias("mean"),
                    F.coalesce(F.var_pop(value).over(w) * F.count(value).over(w), F.lit(0.0)).alias("m2"))


def rolling_mean_std(df: DataFrame, value: str, part: Sequence[str], order: Sequence[str],
                     rows: int = 1000, block_rows: int = 100_000,
                     coarse_seconds: int = COARSE_SECONDS, ts: str = "timestamp", rank: str = "time") -> DataFrame:
    """Adds ``rolling_mean`` and ``rolling_std`` (population) over the last
    ``rows`` rows including the current one, per ``part`` in ``order``; NULL
    values are in no frame.

    ``rank`` picks how rows are numbered: "time" ranks inside buckets of
    ``coarse_seconds``; "range" uses the range partitioner, which also splits a
    single huge bucket (at the price of writing the rows once)."""
    part = list(part)
    halo = rows - 1
    x = with_halo(_ranked(df, part, order, coarse_seconds, ts, rank), part, halo, max(block_rows, halo))
    # one exchange serves all windows: those inside segments are inside blocks too
    x = x.repartition(*part, "_blk").withColumn("_seg", F.floor((F.col("_rn") - 1) / F.lit(rows)).cast("long"))
    segment = Window.partitionBy(*part, "_blk", "_seg")
    head = _partials(value, segment.orderBy("_rn").rowsBetween(Window.unboundedPreceding, 0))
    tail = _partials(value, segment.orderBy(F.desc("_rn")).rowsBetween(Window.unboundedPreceding, 0))
    x = x.withColumn("_tail", tail).withColumn("_head", head)
    # the frame starts ``rows - 1`` rows back, in the segment before unless the
    # row ends its own
    # (ordered like the head's windows, whose sort it shares)
    start = F.lag("_tail", halo).over(Window.partitionBy(*part, "_blk").orderBy("_seg", "_rn")) if halo else F.lit(None)
    whole = F.pmod(F.col("_rn"), F.lit(rows)) == 0
    none = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "mean", "m2")])
    x = x.withColumn("_before", F.when(whole | start.isNull(), none).otherwise(start) if halo else none)
    a, b = F.col("_before"), F.col("_head")
    n = a["n"] + b["n"]
    gap = b["mean"] - a["mean"]
    both = (a["n"] > 0) & (b["n"] > 0)
    mean = (F.when(n == 0, F.lit(None)).when(a["n"] == 0, b["mean"]).when(b["n"] == 0, a["mean"])
            .otherwise(a["mean"] + gap * F.try_divide(b["n"], n)))
    m2 = a["m2"] + b["m2"] + F.when(both, gap * gap * F.try_divide(a["n"] * b["n"], n)).otherwise(F.lit(0.0))
    return (x.where(~F.col("_halo"))
            .withColumns({"rolling_mean": mean, "rolling_std": F.sqrt(F.try_divide(m2, n))})
            .drop("_rn", "_blk", "_halo", "_seg", "_head", "_tail", "_before"))


def previous(df: DataFrame, col: str, part: Sequence[str], order: Sequence[str], name: str,
             block_rows: int = 100_000, coarse_seconds: int = COARSE_SECONDS,
             ts: str = "timestamp", rank: str = "time") -> DataFrame:
    """``lag(col)`` per ``part`` in ``order`` (NULL for the first row)."""
    part = list(part)
    x = with_halo(_ranked(df, part, order, coarse_seconds, ts, rank), part, 1, block_rows)
    w = Window.partitionBy(*part, "_blk").orderBy("_rn")
    return (x.withColumn(name, F.lag(col).over(w))
            .where(~F.col("_halo"))
            .drop("_rn", "_blk", "_halo"))
