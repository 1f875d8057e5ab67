"""Readers and writers.

- CSV is read with a fixed schema, header, FAILFAST and the tick timestamp
  format; the book's JSON-text arrays are decoded with ``from_json``.
- Tables are written day-partitioned, range-partitioned on
  (date, symbol, timestamp) so a hot symbol is split across many tasks, and
  sorted within files so Parquet row-group statistics skip by symbol and time.
  With dynamic partition overwrite a re-load replaces only its own days:
  loading the same file twice does not duplicate rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tape.schemas import CSV_TIMESTAMP_FORMAT, RAW, RAW_CSV

ARRAY_COLUMNS = {"bid_prices": "array<double>", "bid_sizes": "array<bigint>",
                 "ask_prices": "array<double>", "ask_sizes": "array<bigint>"}


class MissingInput(FileNotFoundError):
    """A4: an input path does not exist."""


def read_csv(spark: SparkSession, table: str, path: str | Sequence[str]) -> DataFrame:
    """A1/A2/A4: headered CSV of one raw table, typed and decoded."""
    schema = RAW_CSV[table]
    try:
        df = (spark.read.schema(schema)
              .option("header", True)
              .option("mode", "FAILFAST")
              .option("timestampFormat", CSV_TIMESTAMP_FORMAT)
              .csv(path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise MissingInput(f"{table}: input not found: {path}") from e
        raise
    if table == "order_book_snapshots":
        df = decode_arrays(df)
    return apply_defaults(df)


def decode_arrays(df: DataFrame) -> DataFrame:
    """JSON text → typed arrays."""
    return df.withColumns({c: F.from_json(c, t) for c, t in ARRAY_COLUMNS.items() if c in df.columns})


def encode_arrays(df: DataFrame) -> DataFrame:
    """Inverse of ``decode_arrays`` for the CSV form."""
    return df.withColumns({c: F.to_json(c) for c in ARRAY_COLUMNS if c in df.columns})


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    (encode_arrays(df).write.mode(mode).option("header", True)
     .option("timestampFormat", CSV_TIMESTAMP_FORMAT).csv(path))


def apply_defaults(df: DataFrame) -> DataFrame:
    """A missing flag means 'OK'."""
    if "data_quality_flag" in df.columns:
        df = df.withColumn("data_quality_flag", F.coalesce("data_quality_flag", F.lit("OK")))
    return df


def conform(df: DataFrame, table: str) -> DataFrame:
    """Check the declared columns are present and cast to the contract."""
    schema = RAW[table]
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_table(df: DataFrame, path: str, date_col: str | None = None,
                sort_cols: Sequence[str] = ("symbol", "timestamp"), mode: str = "overwrite",
                partitions: int | None = None, watch: Callable[[DataFrame], DataFrame] | None = None,
                bloom: Sequence[str] = ("symbol",)) -> None:
    """Day-partitioned, sorted, idempotent per day (dynamic overwrite).

    ``date_col`` is derived from ``timestamp`` when missing.  A range
    partitioning on (date, sort columns) balances files even when one symbol
    dominates (a hot symbol is cut by time), and keeps each file to a narrow
    symbol/time range for row-group skipping.  ``partitions`` is the number of
    ranges; without it Spark takes ``spark.sql.shuffle.partitions`` and
    coalesces small ones by its advisory partition size.  ``watch`` sees the rows
    behind the exchange, as they are written.  The columns in ``bloom`` get Parquet
    bloom filters: a reader of one symbol skips row groups whose range holds it
    but which do not.
    """
    sort_cols = [c for c in sort_cols if c in df.columns]
    if date_col:
        if date_col not in df.columns:
            df = df.withColumn(date_col, F.to_date("timestamp"))
        keys = [date_col, *sort_cols]
        df = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
        df = (watch(df) if watch else df).sortWithinPartitions(*keys)
        (with_blooms(df, bloom).mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path))
    else:
        df = watch(df) if watch else df
        if sort_cols:
            df = df.sortWithinPartitions(*sort_cols)
        with_blooms(df, bloom).mode(mode).parquet(path)


def with_blooms(df: DataFrame, columns: Sequence[str]):
    """A writer of ``df`` that adds Parquet bloom filters of ``columns``."""
    writer = df.write
    for c in columns:
        if c in df.columns:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    return writer


#: Day columns that the issue log is partitioned by, and the time of each.
ISSUE_DAYS = {"detected_date": "detected_at", "event_date": "event_time"}
ISSUE_ORDER = ["source_table", "symbol", "detected_at"]


def with_issue_days(issues: DataFrame) -> DataFrame:
    return issues.withColumns({d: F.to_date(t) for d, t in ISSUE_DAYS.items()})


def append_issues(issues: DataFrame, path: str) -> None:
    """Append findings to the issue log, partitioned by day of detection
    and of the event, sorted by source, symbol and time in each file."""
    days = list(ISSUE_DAYS)
    (with_issue_days(issues).repartitionByRange(*days, *ISSUE_ORDER).sortWithinPartitions(*days, *ISSUE_ORDER)
     .write.mode("append").partitionBy(*days).parquet(path))


def reset_issues(spark: SparkSession, path: str, ts_type: T.DataType = T.TimestampType()) -> None:
    """Empty the issue log before a full run (times typed like the source ticks)."""
    from tape.schemas import ISSUES
    schema = T.StructType([T.StructField(f.name, ts_type if isinstance(f.dataType, T.TimestampType) else f.dataType,
                                         f.nullable) for f in ISSUES.fields])
    empty = with_issue_days(spark.createDataFrame([], schema))
    # a static overwrite: the dynamic one would leave the days that are there
    empty.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*ISSUE_DAYS).parquet(path)


def issue_log_schema(ts_type: T.DataType = T.TimestampType()) -> T.StructType:
    """Schema of the written log, for reading it while it may be empty."""
    from tape.schemas import ISSUES
    fields = [T.StructField(f.name, ts_type if isinstance(f.dataType, T.TimestampType) else f.dataType) for f in ISSUES.fields]
    return T.StructType([*fields, *[T.StructField(d, T.DateType()) for d in ISSUE_DAYS]])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can list ``path``, in whatever store it is."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return False
        raise
    return True


def verify_counts(source: DataFrame, written: DataFrame, table: str) -> DataFrame:
    """Source vs written row counts as one row (one pass over each side)."""
    tagged = source.select(F.lit(0).alias("_s")).unionByName(written.select(F.lit(1).alias("_s")))
    return (tagged.agg(F.count_if(F.col("_s") == 0).alias("source_rows"),
                       F.count_if(F.col("_s") == 1).alias("written_rows"))
            .select(F.lit(table).alias("table"), "source_rows", "written_rows",
                    (F.col("source_rows") == F.col("written_rows")).alias("match")))


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A10: a (lazy) view, for SQL over the model."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
