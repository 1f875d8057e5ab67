"""Declared tables (A3, A5, A6, E1): staging tables in the session's catalog with
their columns' types, NOT NULL and defaults, bucketed and sorted.

Buckets are on (symbol, day): a symbol that dominates is spread over the buckets
by its days, and what groups or joins by symbol and day - the daily marts - reads
the buckets as they are, without an exchange.

Spark's file tables take a column's DEFAULT on insert; NOT NULL is documentation
to them.  ``fill`` therefore refuses rows that break it: the insert fails, and the
table stays as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Declared columns: (name, type, constraint).
_DAY = {"stg_trades": "trade_date", "stg_quotes": "quote_date"}
_FLAG = ("data_quality_flag", "STRING", "NOT NULL DEFAULT 'OK'")
COLUMNS = {
    "stg_trades": [("symbol", "STRING", "NOT NULL"), ("timestamp", "TIMESTAMP_NTZ", "NOT NULL"), ("trade_date", "DATE", "NOT NULL"),
                   ("trade_price", "DOUBLE", "NOT NULL"), ("trade_size", "BIGINT", "NOT NULL"), ("trade_notional", "DOUBLE", ""),
                   ("exchange", "STRING", ""), ("trade_condition", "STRING", ""), _FLAG, ("has_quality_issue", "BOOLEAN", "")],
    "stg_quotes": [("symbol", "STRING", "NOT NULL"), ("timestamp", "TIMESTAMP_NTZ", "NOT NULL"), ("quote_date", "DATE", "NOT NULL"),
                   ("bid_price", "DOUBLE", "NOT NULL"), ("ask_price", "DOUBLE", "NOT NULL"), ("bid_size", "BIGINT", ""), ("ask_size", "BIGINT", ""),
                   ("spread", "DOUBLE", ""), ("spread_bps", "DOUBLE", ""), ("mid_price", "DOUBLE", ""), ("exchange", "STRING", ""), _FLAG,
                   ("has_quality_issue", "BOOLEAN", "")],
}


def unique(name: str) -> str:
    return f"tape_{name}_{uuid.uuid4().hex[:12]}"


def declare(spark: SparkSession, model: str, name: str, location: str, extra: str = "", buckets: int | None = None) -> None:
    """Create table ``name`` of a staging ``model`` at ``location``.  ``buckets``
    is sized for the whole table (default: ``spark.sql.shuffle.partitions``);
    ``extra`` are more column definitions."""
    columns = [" ".join(x for x in c if x) for c in COLUMNS[model]] + ([extra] if extra else [])
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"CREATE TABLE {name} ({', '.join(columns)}) USING parquet CLUSTERED BY (symbol, {_DAY[model]}) "
              f"SORTED BY (symbol, {_DAY[model]}, timestamp) INTO {n} BUCKETS LOCATION '{location}'")


def fill(df: DataFrame, model: str, name: str) -> None:
    """Insert ``df`` into a declared table by column names; columns that it lacks
    take their defaults.  Rows are dealt to the buckets first, so that each
    bucket is one file of one insert."""
    spark = df.sparkSession
    table = spark.table(name)
    present = [c for c in table.columns if c in df.columns]
    required = [c for c, _, rule in COLUMNS[model] if rule.startswith("NOT NULL") and c in df.columns]
    for c in required:
        if "DEFAULT" in dict((n, r) for n, _, r in COLUMNS[model])[c]:
            df = df.withColumn(c, F.coalesce(F.col(c), F.lit("OK")))
        else:
            df = df.withColumn(c, F.coalesce(F.col(c), F.raise_error(F.lit(f"{name}.{c} is NULL")).cast(table.schema[c].dataType)))
    n = int(spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first()["data_type"])
    view = unique("rows")
    df.select(*present).repartition(n, "symbol", _DAY[model]).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT INTO {name} ({', '.join(present)}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
