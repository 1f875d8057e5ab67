"""Mixing sources to target token budgets by hash-threshold histograms.

Each source gets a share of the total budget by weight, at most ``cap`` times
its own size; what a capped source cannot take is shared again by weight among
the others.  The water level of that process has a closed form over the sources
in the order of (own limit / weight), so it needs one row per source only.

A target of c whole copies and a rest r is met by taking every document c
times and those below a hash threshold once more.  The threshold is the place
where the running sum of sizes, by hash, reaches r.  It is found without
sorting documents: a histogram of sizes by (source, upper hash bits) names the
boundary bucket, and only that bucket is split further by the next bits, until
one hash value is left.  A larger budget has a larger threshold, so budgets are
nested: growing one only adds documents.

Defined cases: null text has size 0; null sources are a source of their own,
ranked last; rows alike in id and text share a hash and are taken together;
an empty table gives an empty mix.  A document takes at most ``cap`` copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, n_words, staged

#: Hash bits, and how many of them each histogram resolves.
HASH_BITS, STEP_BITS = 60, 15


def mix_hash(key: Column, text: Column) -> Column:
    """60 bits of a hash of (key, text): stable over runs and layouts."""
    named = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: int = 2) -> DataFrame:
    """(source, source_size) -> adds ``target``.  Weights go round the sources
    in code point order, null last.  Works on one row per source."""
    every = Window.partitionBy()
    ranked = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(listed, (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")))
    limit = F.lit(float(cap)) * F.col("source_size")
    by_level = Window.orderBy((F.col("limit") / F.col("weight")).asc(), F.col("rank"))
    below = by_level.rowsBetween(Window.unboundedPreceding, -1)
    levels = ranked.withColumn("limit", limit).select(
        "*",
        (F.lit(float(share)) * F.sum("source_size").over(every)).alias("budget"), F.sum("weight").over(every).alias("all_weight"),
        F.coalesce(F.sum("limit").over(below), F.lit(0.0)).alias("limits_below"), F.coalesce(F.sum("weight").over(below), F.lit(0.0)).alias("weight_below"))
    capped = F.col("limit") * (F.col("all_weight") - F.col("weight_below")) <= F.col("weight") * (F.col("budget") - F.col("limits_below"))
    levels = levels.withColumn("capped", capped).select(
        "*",
        F.coalesce(F.sum(F.when(F.col("capped"), F.col("limit"))).over(every), F.lit(0.0)).alias("limits"),
        F.coalesce(F.sum(F.when(F.col("capped"), F.col("weight"))).over(every), F.lit(0.0)).alias("used"))
    target = F.when(F.col("capped"), F.col("limit")).otherwise(
        F.try_divide(F.col("weight") * (F.col("budget") - F.col("limits")), F.col("all_weight") - F.col("used")))
    return levels.select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``sized`` (source, size, hash), ``targets`` (source, source_size, target)
    -> targets with ``copies`` (taken of every document) and ``cut`` (documents
    with a smaller hash are taken once more)."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = staged(targets.withColumn("copies", whole).withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size")), "mix-targets")
    # state: the one bucket of each source that the threshold lies in, and the
    # words still to take from it
    state = plan.where("rest > 0").select(F.col("source").alias("of"), F.lit(0).cast("long").alias("low"), "rest")
    rows = sized.where("size > 0")
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        upper = shift + STEP_BITS
        inside = F.shiftright("hash", upper) == F.shiftright("low", upper)
        histogram = (rows.join(state, F.col("source").eqNullSafe(F.col("of")) & inside)
                     .groupBy("of", "rest", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("n")))
        running = histogram.withColumn("upto", F.sum("n").over(Window.partitionBy("of").orderBy("bucket")))
        first = running.where("upto > rest").groupBy("of").agg(F.min(F.struct("bucket", "n", "upto", "rest")).alias("b"))
        state = staged(first.select("of", F.shiftleft("b.bucket", shift).alias("low"), (F.col("b.rest") - F.col("b.upto") + F.col("b.n")).alias("rest"), F.col("b.n").alias("n")), "mix-boundary")
    # the last bucket is one hash value: it goes in if that is nearer
    cut = F.coalesce(F.col("low") + F.when(2 * F.col("s.rest") > F.col("n"), F.lit(1)).otherwise(F.lit(0)), F.lit(0).cast("long"))
    ended = plan.alias("p").join(state.alias("s"), F.col("source").eqNullSafe(F.col("of")), "left")
    return staged(ended.select("source", "source_size", "target", "copies", cut.alias("cut")), "mix-plan")


def sized_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(key, source, size, hash), staged: the only pass over the texts."""
    return staged(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), mix_hash(F.col(key), F.col(text)).alias("hash")), "mix-sizes")


def mixing_plan(sized: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: int = 2) -> DataFrame:
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return thresholds(sized, source_targets(totals, weights, share, cap))


def copies_taken(hash_: Column) -> Column:
    return F.col("copies") + F.when(hash_ < F.col("cut"), F.lit(1)).otherwise(F.lit(0))


def mix_sizes(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: int = 2, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """What the mix takes of each document: key, size, source_size, target of
    its source, taken (words, repeats counted)."""
    sized = sized_documents(docs, key, source, text)
    plan = mixing_plan(sized, weights, share, cap).withColumnRenamed("source", "of")
    return sized.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("key").alias(key), "size", "source_size", "target", (F.col("size") * copies_taken(F.col("hash"))).alias("taken"))


def mix_documents(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: int = 2, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mixed documents themselves, with all columns of ``docs``: a row for
    each copy taken.  A document without words goes with its source's whole
    copies, once at least."""
    plan = mixing_plan(sized_documents(docs, key, source, text), weights, share, cap)
    of, copies, cut, source_size, target, n, _ = names = fresh(docs, "of", "copies", "cut", "source_size", "target", "n", "copy")
    plan = plan.select(F.col("source").alias(of), F.col("copies").alias(copies), F.col("cut").alias(cut))
    taken = F.col(copies) + F.when(mix_hash(docs[key], docs[text]) < F.col(cut), F.lit(1)).otherwise(F.lit(0))
    wordless = n_words(docs[text]) == 0
    joined = docs.join(plan, docs[source].eqNullSafe(F.col(of))).withColumn(n, F.when(wordless, F.greatest(F.col(copies), F.lit(1))).otherwise(taken).cast("int"))
    return joined.where(F.col(n) > 0).withColumn(names[-1], F.explode(F.sequence(F.lit(1), F.col(n)))).select(*[F.col(f"`{c}`") for c in docs.columns])
