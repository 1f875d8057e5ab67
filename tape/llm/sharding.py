"""Rendezvous hashing of record keys over weighted shards.

Every shard draws a number for the key from a hash of (key, shard number); the
shard with the largest ``ln(u) / weight`` takes the record.  The draws of one
shard do not depend on the others, so a new shard takes rows only into itself
(about its share of the weight) and a removed one gives up only its own.

Slots are gapless numbers inside a shard.  A shard may hold a sixteenth of all
rows, so nothing sorts a shard: rows fall into hash blocks, are numbered inside
their block, and add the number of rows in the blocks before it.

Defined cases: null ids share the key ``null``; null text counts as no bytes
(size 1, checksum 0); repeated rows get slots of their own; an empty table
gives an empty result.  Text is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Upper hex digits of the block hash: 4,096 blocks in each shard.
BLOCK_DIGITS = 3
DRAW_DIGITS, DRAWS = 13, float(1 << 52)


def draw(key: Column, shard: Column, weight: Column) -> Column:
    """The score of one shard for a key: larger wins."""
    digits = F.substring(F.md5(F.concat(key, F.lit("/"), shard.cast("string")).cast("binary")), 1, DRAW_DIGITS)
    return F.log((F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(DRAWS)) / weight


def rendezvous(key: Column, weights) -> Column:
    """struct(score, shard) of the shard that takes ``key``; ``weights`` has
    one positive weight for each shard."""
    listed = F.array(*[F.lit(float(w)) for w in weights])
    scores = F.transform(F.sequence(F.lit(0), F.lit(len(weights) - 1)), lambda s: F.struct(draw(key, s, F.element_at(listed, s + 1)).alias("score"), (-s).alias("minus")))
    best = F.array_max(scores)  # of equal scores the smaller shard
    return F.struct(best["score"].alias("score"), (-best["minus"]).cast("int").alias("shard"))


def shard_documents(docs: DataFrame, weights=(1.0,) * 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size (UTF-8 bytes + 1), text_crc32, law, shard, slot, grown_shard
    (with one more shard of mean weight)."""
    named = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    n = len(weights)
    extra = sum(weights) / n
    facts = docs.select(
        F.col(key).alias("key"), named.alias("named"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"))
    placed = facts.withColumn("best", rendezvous(F.col("named"), weights)).withColumn("new", draw(F.col("named"), F.lit(n), F.lit(float(extra))))
    block = F.substring(F.md5(F.concat("named", F.lit(":"), F.col("text_crc32").cast("string")).cast("binary")), 1, BLOCK_DIGITS)
    placed = placed.select("key", "size", "text_crc32", F.col("best.shard").alias("shard"),
                           F.when(F.col("new") > F.col("best.score"), F.lit(n)).otherwise(F.col("best.shard")).cast("int").alias("grown_shard"), block.alias("block"))
    in_block = Window.partitionBy("shard", "block")
    numbered = placed.withColumn("place", F.row_number().over(in_block.orderBy("key", "text_crc32", "size")) - 1)
    counts = placed.groupBy("shard", "block").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return numbered.join(starts, ["shard", "block"]).select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("place")).cast("long").alias("slot"), "grown_shard")
