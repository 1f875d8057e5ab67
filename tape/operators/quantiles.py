"""Exact quantiles that do not hold a whole group in one task (D9/D10 at scale).

``percentile`` keeps a value→count map per group and merges it in one task,
so a group holding a third of the rows is one large in-memory map.  This plan
gives the same numbers (Spark's interpolation: position q·(n−1), values at the
floor and ceiling ranks), is lazy, and every step stays bounded:

1. every value falls into a *bucket* that only grows with the value (a fixed
   function of it: steps of about 1/4096 of its size)
2. counts per (group, bucket, value): partial aggregation, and a hot group
   spreads over many tasks
3. counts per (group, bucket), and running sums over a group's buckets: where
   each bucket's ranks begin, and the group's size
4. only the buckets that hold a target rank (≤ 2 per quantile and group) meet
   their values again; running counts inside these buckets give the ranks
5. pick the values at the target ranks and interpolate
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tape.operators.windows import null_safe_join

#: Buckets of a doubling of the value, about.
STEPS = 4096


def value_bucket(value: Column) -> Column:
    """A whole number that never falls as ``value`` grows; NaN comes last, as in
    Spark's order."""
    x = value.cast("double")
    size = F.floor(F.log1p(F.abs(x)) * F.lit(float(STEPS)))
    return F.when(F.isnan(x), F.lit(2**63 - 1)).when(x < 0, -1 - size).otherwise(size)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float],
                    names: Sequence[str] | None = None, partitions: int | None = None) -> DataFrame:
    """One row per group: ``keys`` + one double column per quantile in ``qs``
    (named by ``names``, default ``q<i>``).  NULL values are ignored.
    ``partitions`` is the number of tasks that the value counts are dealt to
    (else Spark's)."""
    keys = list(keys)
    names = list(names or [f"q{i}" for i in range(len(qs))])
    counts = (df.where(F.col(value).isNotNull()).select(*keys, value, value_bucket(F.col(value)).alias("_b"))
              .groupBy(*keys, "_b", value).agg(F.count(F.lit(1)).alias("_c")))
    if partitions:
        counts = counts.repartition(partitions, *keys, "_b", value)
    group = Window.partitionBy(*keys)
    buckets = (counts.groupBy(*keys, "_b").agg(F.sum("_c").alias("_bc"))
               .withColumn("_upto", F.sum("_bc").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)))
               .withColumn("_n", F.sum("_bc").over(group)))
    pos = {i: F.lit(float(q)) * (F.col("_n") - 1).cast("double") for i, q in enumerate(qs)}

    def covers(rank, start, end):
        return (F.col(start) <= rank) & (rank < F.col(end))

    ranks = [r(pos[i]) for i in range(len(qs)) for r in (F.floor, F.ceil)]
    buckets = buckets.withColumn("_from", F.col("_upto") - F.col("_bc"))
    wanted = buckets.where(reduce(or_, [covers(r, "_from", "_upto") for r in ranks])).select(*keys, "_b", "_n", "_from")
    inside = Window.partitionBy(*keys, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = (null_safe_join(counts, wanted, [*keys, "_b"])
              .withColumn("_end", F.col("_from") + F.sum("_c").over(inside))
              .withColumn("_start", F.col("_end") - F.col("_c")))
    aggs = []
    for i in range(len(qs)):
        for name, rank in (("lo", F.floor(pos[i])), ("hi", F.ceil(pos[i]))):
            aggs.append(F.max(F.when(covers(rank, "_start", "_end"), F.col(value))).alias(f"_{name}{i}"))
    picked = ranked.groupBy(*keys, "_n").agg(*aggs)
    outs = []
    for i, name in enumerate(names):
        p = pos[i]
        lo_r, hi_r = F.floor(p), F.ceil(p)
        lo_v, hi_v = F.col(f"_lo{i}").cast("double"), F.col(f"_hi{i}").cast("double")
        interp = (hi_r.cast("double") - p) * lo_v + (p - lo_r.cast("double")) * hi_v
        outs.append(F.when((lo_r == hi_r) | (lo_v == hi_v), lo_v).otherwise(interp).alias(name))
    return picked.select(*keys, *outs)
