"""Connected components of a graph given as a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.staging import stage

MOST_ROUNDS = 60


def _downhill(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node with a link; label is the smallest node reachable.

    Alternates large-star and small-star rounds: each node hands its smallest
    neighbour to its larger, then to its smaller neighbours, until the links are
    stars around the labels.  The number of rounds grows with the logarithm of the
    longest path.  The smallest neighbour is found by an aggregation that combines
    before its shuffle, and written to a table before the join, so that Spark can
    split the partition of a node with very many links.
    """
    links = stage(_downhill(links.select("u", "v")), "links")
    before = None
    for _ in range(MOST_ROUNDS):
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = stage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "lowest")
        large = stage(both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .filter("u <> v").distinct(), "large-star")
        lowest = stage(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            lowest.select("u", F.col("m").alias("v")))
        links = stage(_downhill(small), "small-star")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            roots = links.select(F.col("v").alias("node")).distinct()
            return links.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                roots.select("node", F.col("node").alias("label")))
        before = now
    raise RuntimeError("components did not settle")
