"""Session settings the library relies on.

Ticks are stored in UTC and bucket columns keep the type of their input
timestamp, so the session time zone must be UTC (``configure`` sets it).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# SQL settings applied to every session the library touches.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Allow a broadcast only below a measured size (AQE checks runtime stats).
    # Sizes estimated before the run come from compressed files: sorted ticks are
    # many times as large in memory, so no broadcast is planned from them.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def cluster_conf(input_bytes: int, partition_bytes: int = 256 * 1024 * 1024,
                 shuffle_ratio: float = 0.5) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of Parquet on a cluster: file
    splits and shuffle partitions of about ``partition_bytes`` each, sized from
    the data (not the 200-partition default), with AQE coalescing small ones.
    ``shuffle_ratio`` is the expected shuffled share of the input.  Pass the
    result to ``get_session(extra=...)`` or ``spark-submit --conf``."""
    shuffle = max(200, int(input_bytes * shuffle_ratio // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    }


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SQL_CONF.items():
        spark.conf.set(k, v)
    return spark


def get_session(master: str | None = None, app: str = "tape",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session. ``master`` is only set when given, so a
    cluster submit keeps its own master."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system).
    Only where it is unset and all of Spark runs in this process (tests,
    notebooks) a folder below ``spark.sql.warehouse.dir`` is taken.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: what follows sees
    one evaluation of it, whatever is recomputed."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
