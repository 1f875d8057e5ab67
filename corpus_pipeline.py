"""The corpus pipeline: documents to sharded training rows.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tape.llm.common import staged, table
from tape.llm.decontaminate import without_contamination
from tape.llm.jaccard import one_of_each
from tape.llm.mixing import mix_documents
from tape.llm.quality import good_documents
from tape.llm.sharding import shard_documents


#: Rows of whole texts that a stage sends to Python at once: the default of 10,000
#: holds some 64 MB of them several times over, beside a full heap.
ROWS_AT_ONCE = 1000


def bounded(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier keeps."""
    bounded(spark)
    return good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8): that of the
    smallest id."""
    bounded(spark)
    return one_of_each(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window of ten words."""
    bounded(spark)
    return without_contamination(docs, table(spark, sf_dir, "benchmark"), size=10)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes: sources weigh 5, 2, 1, repeating,
    share 150 % of all words, at most twice their own."""
    return mix_documents(docs, weights=(5, 2, 1), share=1.5, cap=2)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every copy."""
    return shard_documents(docs, weights=(1.0,) * 16)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The classifier is fitted: SQL cannot express its decisions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
