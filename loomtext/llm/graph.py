"""Connected components of links that never leave the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.operators.scale import written


def _stars(links: DataFrame) -> DataFrame:
    """Hang the larger neighbours of every node on the smallest one, then the smaller ones too."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = written(large, "links-large")  # one row per link at most; repeated ones go below
    lower = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(lower, "u").filter("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    own = lower.select(F.col("m").alias("a"), F.col("u").alias("b"))
    return written(small.union(own).distinct(), "links")


def _done(links: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and none that hangs has others below it."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("above"), F.lit(0).alias("below")).union(
        links.select("b", F.lit(0), F.lit(1))
    )
    return ends.groupBy("node").agg((F.max("above") + F.sum("below")).alias("n")).filter("n > 1").isEmpty()


def hung(links: DataFrame) -> DataFrame:
    """Every linked node but the smallest of its component, which it hangs on: ``node, component``.

    ``links``: two columns a < b. Alternating large and small stars, a logarithmic number of
    rounds, until the links are stars; a node with very many links is folded by partial aggregates
    and by Spark's splitting of skewed joins. Every round is written to the shared folder, so no
    lineage grows; so is the result.
    """
    links = written(links.toDF("a", "b").distinct(), "links")
    while not _done(links):
        links = _stars(links)
    return links.select(F.col("b").alias("node"), F.col("a").alias("component"))


def components(links: DataFrame) -> DataFrame:
    """Every linked node with the smallest node of its component: ``node, component``."""
    found = hung(links)
    return found.union(found.select("component", "component").distinct())
