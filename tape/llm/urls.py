"""URL filters: association rules mined by Spark FP-growth.

A URL becomes a set of tokens (the last two host labels, each label before
them, path segments with digits masked, names of query parameters).  Labelled URLs,
each with the token of its label, are mined with FP-growth; of the rules
``tokens -> block`` those with enough confidence and support, and with no
shorter such rule among their tokens, stay.

Matching is by inverted index: every rule lists its tokens, every distinct URL
meets the rules on its tokens, and a rule fits where all its tokens were met.

Given (host, path) rules come first: a rule fits its host and all subdomains if
the path starts with the rule's path, and the longest wins.  Mined rules decide
the rest: block where one fits, else allow.

The rules are mined from labelled pages that no given rule judges, so support and
confidence are shares of the pages that the rules are for.

Defined cases: null or scheme-less URLs have an empty host and path, no tokens
and the verdict allow; equal URLs are judged once; without labels, on fewer
labelled URLs than the least count, or without frequent tokens there are no
mined rules.  All steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, staged

#: Given rules: (host, path, verdict).
GIVEN = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Pruning of mined rules: number of labelled URLs to be blocked that have all
#: of a rule's tokens, whatever the input's size, and their share of all
#: labelled URLs that have them.
MIN_COUNT, MIN_CONFIDENCE = 30, 0.9
#: Token of a labelled URL that is to be blocked.
BLOCK = "label=block"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def given_rule(host: Column, path: Column, rules=GIVEN) -> Column:
    """struct(rule, verdict) of the longest given rule that fits, else null."""
    fits = [F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(len(h)).alias("size"), F.lit(len(p)).alias("depth"), F.lit(f"{h}{p}").alias("rule"), F.lit(v).alias("verdict"))) for h, p, v in rules]
    return F.array_max(F.array_compact(F.array(*fits)))


def url_tokens(url: Column) -> Column:
    """The distinct tokens of a URL."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    masked = F.regexp_replace(path, r"\d+", "0")
    parts = F.concat(
        F.transform(F.slice(labels, F.lit(1), F.greatest(n - 2, F.lit(0))), lambda x: F.concat(F.lit("host="), x)),
        F.array(F.concat(F.lit("site="), F.substring_index(host, ".", -2))),
        F.transform(F.split(masked, "/"), lambda x: F.when(x != "", F.concat(F.lit("path="), x))),
        F.transform(F.split(query, "&"), lambda x: F.when(x != "", F.concat(F.lit("query="), F.regexp_extract(x, r"^([^=]*)", 1)))))
    known = F.filter(F.array_compact(parts), lambda x: ~x.isin("host=", "site="))
    return F.coalesce(F.array_distinct(F.when(host != "", known)), F.array().cast("array<string>"))


def mine(labelled: DataFrame, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(rule, size, confidence, token): the inverted index of the mined rules,
    from (url, block).

    Tokens that are rules by themselves, and those on fewer than ``min_count``
    URLs to be blocked, are in no longer rule that stays; FP-growth gets the
    others."""
    numbered = labelled.select(F.monotonically_increasing_id().alias("basket"), "block", url_tokens(F.col("url")).alias("items"))
    tokens = staged(numbered.select("basket", "block", F.explode("items").alias("token")), "url-tokens")
    counts = tokens.groupBy("token").agg(F.count("*").alias("n"), F.count_if("block").alias("bad")).where(F.col("bad") >= min_count)
    counts = staged(counts.select("token", (F.col("bad") / F.col("n")).alias("confidence")), "url-counts")
    single = F.col("confidence") >= min_confidence
    baskets = tokens.join(counts.where(~single).select("token"), "token").groupBy("basket", "block").agg(F.collect_list("token").alias("items"))
    baskets = staged(baskets.select(F.when(F.col("block"), F.array_append("items", BLOCK)).otherwise(F.col("items")).alias("items")), "url-baskets")
    n = baskets.count()
    if n < min_count:  # no rule can have its count
        baskets, n = baskets.limit(0), min_count
    # half a URL less, so that rounding the share back gives the count
    model = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / n, minConfidence=min_confidence).fit(baskets)
    longer = model.associationRules.where(F.array_contains("consequent", BLOCK)).select(F.array_sort("antecedent").alias("tokens"), "confidence")
    rules = staged(longer.unionByName(counts.where(single).select(F.array("token").alias("tokens"), "confidence")), "url-rules")
    # a rule whose tokens hold those of a shorter rule adds nothing
    listed = rules.select(F.array_join("tokens", " ").alias("rule"), F.size("tokens").alias("size"), "confidence", F.explode("tokens").alias("token"))
    shorter = listed.select(F.col("rule").alias("part"), F.col("size").alias("part_size"), "token")
    held = (listed.join(shorter, "token").where("part_size < size").groupBy("rule", "part", "part_size").agg(F.count("*").alias("n")).where("n = part_size").select("rule").distinct())
    return staged(listed.join(held, "rule", "left_anti"), "url-index")


def blocked_urls(urls: DataFrame, index: DataFrame) -> DataFrame:
    """(url, mined): the distinct URLs that a mined rule fits, and the rule of
    the largest confidence."""
    met = urls.select("url", F.explode(url_tokens(F.col("url"))).alias("token")).join(index, "token")
    full = met.groupBy("url", "rule", "size", "confidence").agg(F.count("*").alias("n")).where("n = size")
    return full.groupBy("url").agg(F.max(F.struct("confidence", "rule")).alias("best")).select("url", F.col("best.rule").alias("mined"))


def judge(pages: DataFrame, labels: DataFrame, key: str = "page_id", url: str = "url", rules=GIVEN, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """key, host, path, rule, verdict and mined rule of every page.  ``labels``
    is (page, block): what is known of pages.  Only pages that no given rule
    judges teach the mined rules."""
    named = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    given = given_rule(host_of(F.col("url")), path_of(F.col("url")), rules)
    known = labels.where("page is not null").groupBy("page").agg(F.max("block").alias("bad"))
    taught = named.where(F.col("url").isNotNull() & given.isNull()).join(known, F.col("key") == F.col("page")).select("url", F.col("bad").alias("block")).where("block is not null")
    index = mine(taught, min_count, min_confidence)
    open_ = named.where(F.col("url").isNotNull() & given.isNull()).select("url").distinct()
    mined = blocked_urls(open_, index).withColumnRenamed("url", "mined_url")
    judged = named.join(mined, F.col("url") == F.col("mined_url"), "left").withColumn("given", given)
    verdict = F.coalesce(F.col("given.verdict"), F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return judged.select(F.col("key").alias(key), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("given.rule").alias("rule"), verdict.alias("verdict"), F.when(F.col("given").isNull(), F.col("mined")).alias("mined_rule"))
