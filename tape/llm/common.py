"""Small Spark helpers that the operators share."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark's own reader (any store it knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Only where it is unset *and* all of Spark runs in this process (tests,
    notebooks) a folder below the working directory's ``spark-warehouse`` is
    taken; on a cluster the setting is required."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "staged")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts the
    lineage, survives lost executors, and gives the planner a true size."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores before it until no column of ``df`` (in any
    letter case) has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased; every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def n_words(c: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words of a text; 0 for null.

    Runs of separators become one space; the words are then one more than the
    spaces between them, which a length difference counts without building
    the words."""
    flat = F.trim(F.regexp_replace(c, r"[\x20\x09-\x0D]+", " "))
    n = F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + F.lit(1)
    return F.when(flat.isNull() | (flat == ""), F.lit(0)).otherwise(n).cast("long")


def append_columns(df: DataFrame, text: str, fields: list[StructField], compute) -> DataFrame:
    """``df`` with more columns, computed from its text column alone in Arrow
    batches.  ``compute(text array)`` returns one Arrow array for each field;
    ``fields`` must be new names."""
    schema = StructType([*df.schema.fields, *fields])
    names = [f.name for f in schema.fields]
    at = df.columns.index(text)

    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *compute(batch.column(at))], names=names)

    return df.mapInArrow(rows, schema)


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Jobs that run inside have these settings (dots written as two underscores)."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def arrow_rows(spark: SparkSession, most: int):
    """Jobs that run inside send at most ``most`` rows to Python at once: rows of
    whole texts or sets are large, and a batch is held several times over."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Bits of an id bitmap: 2 MB, whatever the number of ids.
BITMAP_BITS = 24


def _slot(key: Column) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))


def id_bitmap(ids: DataFrame, column: str) -> DataFrame:
    """(word, bits): a bitmap of the hashes of ``ids``, a bit each, in words of
    63 bits: at most 2**BITMAP_BITS / 63 rows.  It is a filter before a join, not
    instead of one: no id is missed, and more ids than bits only let more rows
    through."""
    return (ids.select(_slot(F.col(column)).alias("slot")).groupBy(F.expr("slot div 63").alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(slot % 63 as int)))").alias("bits")))


def flagged(df: DataFrame, key: Column, bitmap: DataFrame, name: str) -> DataFrame:
    """``df`` with a column ``name``, false only where ``key`` is surely not in
    the bitmap's ids.  The bitmap has a fixed greatest size and is broadcast."""
    slot, word, bits = fresh(df, "slot", "word", "bits")
    words = F.broadcast(bitmap.select(F.col("word").alias(word), F.col("bits").alias(bits)))
    joined = df.withColumn(slot, _slot(key)).join(words, F.expr(f"{slot} div 63") == F.col(word), "left")
    hit = F.expr(f"coalesce({bits} & shiftleft(1L, cast({slot} % 63 as int)), 0L) <> 0")
    return joined.withColumn(name, hit).drop(slot, word, bits)
