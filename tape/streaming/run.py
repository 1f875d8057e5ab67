"""Run a streaming query to completion into a Parquet sink and read it back.

The sink and the checkpoint live under the session's shared checkpoint folder
(``spark.checkpoint.dir``), so a restarted driver resumes from the last
committed offsets and the file sink commits each micro-batch exactly once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tape.session import checkpoint_dir


def tick_stream(spark: SparkSession, directory: str, glob: str = "*.parquet",
                max_files_per_trigger: int | None = None, end_dir: str | None = None) -> DataFrame:
    """A file stream over the Parquet files of ``directory`` matching ``glob``,
    with the schema taken from the files present now, and over ``end_dir``,
    where ``write_end_tick`` puts the tick that closes the stream."""
    schema = spark.read.option("pathGlobFilter", glob).parquet(directory).schema

    def files(path, pattern):
        r = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.parquet(path)
    out = files(directory, glob)
    if end_dir is not None:
        spark.createDataFrame([], schema).write.mode("append").parquet(end_dir)
        out = out.unionByName(files(end_dir, "*.parquet"))
    return out


def write_end_tick(spark: SparkSession, schema, end_dir: str, **values) -> None:
    """End of input: one tick of a symbol of its own, later than every other by
    more than the watermark and a window.  It moves the watermark past all real
    ticks, so every open window and pending tick comes out; its own window
    stays open and is never emitted."""
    row = tuple(values.get(f.name) for f in schema.fields)
    spark.createDataFrame([row], schema).write.mode("append").parquet(end_dir)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/stream-{name}-{uuid.uuid4().hex[:12]}"


def run_to_parquet(df: DataFrame, name: str, end=None) -> DataFrame:
    """Process everything available (append mode), then read the sink back.
    ``end`` is called once the input is read, to close the stream."""
    spark = df.sparkSession
    base = scratch(spark, name)
    q = (df.writeStream.format("parquet").outputMode("append")
         .option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
         .start())
    try:
        q.processAllAvailable()
        if end is not None:
            end()
            q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def run_foreach_batch(df: DataFrame, fn, name: str) -> str:
    """Drive a ``foreachBatch`` sink over all available input; returns the
    scratch base folder."""
    spark = df.sparkSession
    base = scratch(spark, name)
    q = df.writeStream.foreachBatch(fn).option("checkpointLocation", f"{base}/ckpt").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return base
