"""Connected components of a link table by alternating large-star and small-star steps; nothing goes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import discard, materialize


def _stars(edges: DataFrame) -> bool:
    """Whether every ``a`` has one ``b`` and no ``b`` is an ``a``: the links are stars around their smallest nodes."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    return not ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").take(1)


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` links (longs) to ``node, label``: the smallest node of its component, for every node that has a link.

    Each step is two aggregations with partial sums and two joins; a node with many links is a skewed join key that
    adaptive execution splits. A star needs two steps, a chain about the logarithm of its length.
    """
    now = materialize(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        after = materialize(small)
        discard(now)
        now = after
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels of :func:`components` after further links: only the components that the links join are worked on."""
    ends = links.join(labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left")
    ends = ends.join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left")
    ends = materialize(ends.select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb")))
    joined = components(ends.select(F.col("la").alias("a"), F.col("lb").alias("b"))).select(F.col("node").alias("label"), F.col("label").alias("to"))
    every = labels.unionByName(ends.select(F.col("a").alias("node"), F.col("la").alias("label"))).unionByName(ends.select(F.col("b").alias("node"), F.col("lb").alias("label")))
    return every.distinct().join(joined, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
