"""Input contracts enforced at load (A1, A6, A7, A12): good rows and quarantine.

A table's contract is its declared columns and types (``tape.schemas``), which
columns may not be NULL, the flag domains and the range of the unsigned sizes.

``read_checked`` reads CSV in PERMISSIVE mode: a record that does not parse keeps
its text in ``record`` instead of ending the job.  ``judged`` lists every row's
``faults``.  ``write_checked`` writes good and bad rows in one job, as partitions
of one table:

    verdict=good/date=<day>/load=<null>      replaced day by day
    verdict=bad/date=<null>/load=<load>      replaced load by load

so no row is lost between the two, a day's re-load replaces its good rows, and
the same load again replaces its own quarantine.  The counts come with the write
(``DataFrame.observe`` behind the last exchange).  If an executor is lost while it
runs, tasks that run again may count twice; ``load_report`` counts what is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tape.schemas import BOOK_FLAGS, CSV_TIMESTAMP_FORMAT, QUOTE_FLAGS, RAW, RAW_CSV, TRADE_FLAGS, UNSIGNED_MAX
from tape.sources import io

FLAGS = {"trades": TRADE_FLAGS, "quotes": QUOTE_FLAGS, "order_book_snapshots": BOOK_FLAGS}
UNSIGNED = ("trade_size", "bid_size", "ask_size")
UNSIGNED_ARRAYS = ("bid_sizes", "ask_sizes")
#: Columns that a checked table has beside its own.
EXTRA = ("record", "faults", "verdict", "date", "load")


def read_checked(spark: SparkSession, table: str, path: str | Sequence[str]) -> DataFrame:
    """Headered CSV of one raw table, typed and decoded; ``record`` holds the text
    of a record that does not parse (wrong number of fields, bad number or time),
    else NULL.  A header that differs from the declared columns is an error."""
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in RAW_CSV[table].fields], T.StructField("record", T.StringType())])
    try:
        df = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "record")
              .option("columnPruning", False)  # all fields are parsed, whatever is selected
              .option("timestampFormat", CSV_TIMESTAMP_FORMAT).csv(path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise io.MissingInput(f"{table}: input not found: {path}") from e
        raise
    if table == "order_book_snapshots":
        arrays = [c for c in io.ARRAY_COLUMNS]
        # text that is no array of its type is as bad as a record that does not parse
        broken = [F.col(c).isNotNull() & F.from_json(c, io.ARRAY_COLUMNS[c]).isNull() for c in arrays]
        some = broken[0]
        for b in broken[1:]:
            some = some | b
        text = F.coalesce("record", F.when(some, F.to_json(F.struct(*arrays))))
        df = io.decode_arrays(df.withColumn("record", text))
    return df


def faults(df: DataFrame, table: str) -> Column:
    """The rules that a row breaks, in the order of the columns; a record that
    did not parse has only that one."""
    found = []
    for f in RAW[table].fields:
        c = F.col(f.name)
        if f.name != "data_quality_flag":  # A6: a missing flag means 'OK'
            found.append(F.when(c.isNull(), F.lit(f"null {f.name}")))
        outside = None
        if f.name == "data_quality_flag":
            outside = ~c.isin(FLAGS[table])
        elif f.name in UNSIGNED:
            outside = ~c.between(0, UNSIGNED_MAX)
        elif f.name in UNSIGNED_ARRAYS:
            outside = F.exists(c, lambda x: x.isNull() | ~x.between(0, UNSIGNED_MAX))
        elif isinstance(f.dataType, T.ArrayType):
            outside = F.exists(c, lambda x: x.isNull())
        if outside is not None:
            found.append(F.when(outside, F.lit(f"domain {f.name}")))
    broken = F.array_compact(F.array(*found))
    return F.when(F.col("record").isNotNull(), F.array(F.lit("malformed"))).otherwise(broken)


def judged(df: DataFrame, table: str) -> DataFrame:
    """``df`` (which must have the declared columns) with ``record``, ``faults``,
    ``verdict``; missing flags set."""
    missing = [f.name for f in RAW[table].fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    if "record" not in df.columns:
        df = df.withColumn("record", F.lit(None).cast("string"))
    df = df.withColumn("faults", faults(df, table))
    return io.apply_defaults(df).withColumn("verdict", F.when(F.size("faults") == 0, "good").otherwise("bad"))


def placed(df: DataFrame, table: str, load: str = "") -> DataFrame:
    """``df`` judged, with the columns that its rows are filed under.  Its schema
    reads the table back even where nothing is written."""
    good = F.col("verdict") == "good"
    return judged(df, table).withColumns({"date": F.when(good, F.to_date("timestamp")), "load": F.when(~good, F.lit(load))})


def write_checked(df: DataFrame, table: str, path: str, load: str, partitions: int | None = None) -> dict[str, int]:
    """Write ``df``, judged, to the checked table at ``path``; returns the numbers
    of rows ``rows_in``, ``rows_good`` and ``rows_bad``.  ``load`` names the input,
    so that loading it again replaces what it brought."""
    good = F.col("verdict") == "good"
    out = placed(df, table, load)
    schema = out.schema
    keys = ["verdict", "date", "symbol", "timestamp"]
    out = out.repartitionByRange(partitions, *keys) if partitions else out.repartitionByRange(*keys)
    counts = Observation()
    out = out.observe(counts, F.count(F.lit(1)).alias("rows_in"), F.count_if(good).alias("rows_good"), F.count_if(~good).alias("rows_bad"))
    (out.sortWithinPartitions(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("verdict", "date", "load").parquet(path))
    found = counts.get
    if not found["rows_bad"]:
        # nothing overwrote what an earlier run of this load has left there
        old = quarantine(df.sparkSession, path, schema).where(F.col("load") == load)
        if not old.isEmpty():
            empty = out.where(F.lit(False)).drop("verdict", "date", "load")
            empty.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/verdict=bad/date=__HIVE_DEFAULT_PARTITION__/load={load}")
    return found


def _checked(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    reader = spark.read.option("basePath", path)
    df = (reader.schema(schema) if schema else reader).parquet(path)
    # typed as text, also where every value is of one kind or none
    return df.withColumns({c: F.col(c).cast("string") for c in ("verdict", "load")}).withColumn("date", F.col("date").cast("date"))


def good(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The good rows of a checked table: its own columns and ``date``.  A table
    that may be empty needs the ``schema`` of ``placed``."""
    df = _checked(spark, path, schema).where(F.col("verdict") == "good")
    return df.drop(*[c for c in EXTRA if c != "date"])


def quarantine(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The bad rows of a checked table with ``record``, ``faults`` and ``load``."""
    return _checked(spark, path, schema).where(F.col("verdict") == "bad").drop("verdict", "date")


def load_report(spark: SparkSession, table: str, path: str, schema: T.StructType | None = None) -> DataFrame:
    """(table, verdict, fault, n_rows) of what is written: a bad row counts once
    for each fault, and once as fault 'any'; good rows have fault ''."""
    df = _checked(spark, path, schema)
    kinds = F.when(F.col("verdict") == "good", F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("any")), F.col("faults")))
    return (df.select("verdict", F.explode(kinds).alias("fault")).groupBy("verdict", "fault").agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(table).alias("table"), "verdict", "fault", "n_rows"))
