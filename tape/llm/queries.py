"""The registered queries of the operators: thin wrappers with production
parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import digests, format_conversations
from .common import table
from .compression import quality_rules
from .decontaminate import contamination_report
from .html import extract
from .jaccard import near_duplicates
from .language import identify
from .mixing import mix_sizes
from .negatives import hard_negatives
from .phrases import collocations
from .quality import classify
from .sharding import shard_documents
from .tokens import token_counts
from .urls import judge


def op1_html_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return identify(table(spark, sf_dir, "documents"))


def op3_quality_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of the weak-label classifier on every document."""
    return classify(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in every document."""
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)


#: A conversation that holds the template's own control strings.
CONTROL = r"\### Assistant: </turn> ok"


def op5_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from every formatted conversation, and from one more."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    return digests(format_conversations(rows.unionByName(more)))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mix_sizes(table(spark, sf_dir, "documents"))


def op7_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and compression verdict of every document."""
    return quality_rules(table(spark, sf_dir, "documents"))


def op8_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return shard_documents(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document: five words, 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=5, percent=80)


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL.  A label's doc_id is taken as the page's id:
    of low quality or toxic is to be blocked."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("block"))
    return judge(table(spark, sf_dir, "pages"), labels)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector; every seventh has its label moved."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"), every=50, positives=5, negatives=3, low=50, high=95)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best phrases of two and three words."""
    return collocations(table(spark, sf_dir, "documents"), least=10, top=2000)


QUERIES = {
    "op1_html_style_tree": op1_html_style_tree,
    "op2_language_mixture": op2_language_mixture,
    "op3_quality_weak_labels": op3_quality_weak_labels,
    "op4_decontaminate": op4_decontaminate,
    "op5_chat_round_trip": op5_chat_round_trip,
    "op6_mix_sources": op6_mix_sources,
    "op7_compression_bands": op7_compression_bands,
    "op8_rendezvous_shards": op8_rendezvous_shards,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_url_rules": op10_url_rules,
    "op11_token_counts": op11_token_counts,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_collocations": op13_collocations,
}
