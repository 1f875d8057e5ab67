"""Connected components of an edge table by alternating large-star and
small-star steps (Kiveris et al., 2014): every step is a minimum per node and a
join, so no task holds a component and the number of rounds is logarithmic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _hook(edges: DataFrame, larger: bool) -> DataFrame:
    """For every node u: its neighbours (those above it for the large star, u
    and those below it for the small star) hang on the least of u and them."""
    if larger:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    hung = both.join(least, "a")
    if larger:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(class, root) for every class with a link; root is the smallest class of
    its component."""
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(most_rounds):
        edges = staged(_hook(_hook(edges, True), False), "edges")
        # stars: every node hangs once, and nothing hangs on a node that hangs
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        if seen.where("up > 1 or (up > 0 and down > 0)").isEmpty():
            return edges.select(F.col("a").alias("class"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("class"), F.col("b").alias("root")).distinct())
    raise RuntimeError("components did not settle")
