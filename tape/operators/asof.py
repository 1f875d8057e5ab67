"""As-of join: each trade with the prevailing (latest earlier) quote of its
symbol — the one join the source system names as missing.

One plan for every size, without a per-symbol partition or pairwise candidates:

1. Tag and union both sides; bucket by the minute.
2. Inside (symbol, bucket), ``last(quote, ignorenulls)`` over the running
   frame gives the prevailing quote when one exists earlier in the bucket.
3. For rows whose bucket has no earlier quote, carry the last quote of the
   buckets before: per (symbol, bucket) the last quote, run forward inside the
   (symbol, day), and the last quote of each day run forward over the days.

Order is (time, side, tie keys), NULLs first, in every step; symbols compare
null-safe.  ``strict=True`` requires the quote to be strictly earlier than the
trade; otherwise a quote at the same timestamp prevails (quotes sort first).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tape.functions.time import bucket, to_date
from tape.operators.windows import COARSE_SECONDS, null_safe_join


def prevailing(left: DataFrame, right: DataFrame, right_cols: Sequence[str], by: str = "symbol",
               ts: str = "timestamp", right_tie: Sequence[str] = (),
               strict: bool = False, coarse_seconds: int = COARSE_SECONDS, prefix: str = "q_") -> DataFrame:
    """Left as-of join: ``left`` rows + ``prefix``-named columns of the
    prevailing ``right`` row (NULL when none)."""
    left_cols = left.columns
    # quotes at the same timestamp: without a tie key, order them by their own
    # values so the choice is the same on every run (and on recomputation)
    right_tie = list(right_tie) or [c for c in right_cols if c != ts]
    q = F.struct(*[F.col(c).alias(c) for c in [ts, *right_cols]])
    # order key: time, then side (quotes first unless strict), then tie keys
    r_side, l_side = (1, 0) if strict else (0, 1)
    R = right.select(by, ts, F.lit(r_side).alias("_side"), q.alias("_q"),
                     F.struct(*[F.col(c) for c in right_tie]).alias("_rt"))
    L = left.select(by, ts, F.lit(l_side).alias("_side"), F.lit(None).cast(R.schema["_q"].dataType).alias("_q"),
                    F.lit(None).cast(R.schema["_rt"].dataType).alias("_rt"),
                    F.struct(*[F.col(c) for c in left_cols]).alias("_row"))
    u = L.unionByName(R, allowMissingColumns=True).withColumn("_cb", bucket(ts, coarse_seconds))
    upto = (Window.partitionBy(by, "_cb").orderBy(ts, "_side", "_rt")
            .rowsBetween(Window.unboundedPreceding, 0))
    near = u.withColumn("_last", F.last("_q", ignorenulls=True).over(upto)).where(F.col("_row").isNotNull())
    # every (symbol, bucket) of both sides with the last quote in it
    newest = F.max(F.when(F.col("_q").isNotNull(), F.struct(F.col(ts).alias("_t"), "_rt", "_q")))
    buckets = u.groupBy(by, "_cb").agg(newest.alias("_m")).select(by, "_cb", to_date("_cb").alias("_cd"), F.col("_m._q").alias("_bq"))
    in_day = Window.partitionBy(by, "_cd").orderBy("_cb").rowsBetween(Window.unboundedPreceding, -1)
    days = buckets.groupBy(by, "_cd").agg(F.max(F.when(F.col("_bq").isNotNull(), F.struct("_cb", "_bq"))).alias("_m"))
    earlier = Window.partitionBy(by).orderBy("_cd").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(by, "_cd", F.last(F.col("_m._bq"), ignorenulls=True).over(earlier).alias("_dq"))
    carry = (null_safe_join(buckets.withColumn("_iq", F.last("_bq", ignorenulls=True).over(in_day)), days, [by, "_cd"])
             .select(by, "_cb", F.coalesce("_iq", "_dq").alias("_carry")))
    out = null_safe_join(near, carry, [by, "_cb"], "left").withColumn("_m", F.coalesce("_last", "_carry"))
    return out.select(*[F.col("_row")[c].alias(c) for c in left_cols],
                      *[F.col("_m")[c].alias(prefix + c) for c in [ts, *right_cols]])
