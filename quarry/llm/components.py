"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, label): nodes get equal labels exactly if links join them.

    In a round every node moves to the smallest of its neighbours and itself; links follow
    their ends, and those within one node go. A link (u, smallest neighbour of u) keeps the
    two places joined, so nothing falls apart. Nodes should be ordered at random, as digests
    are: then only the local minima stay, and the number of rounds is about the logarithm of
    the longest chain. Each round aggregates with map-side partial minima, so a hub is no
    hot task; rounds are checkpointed."""
    links = cut_lineage(links.filter("a <> b").distinct())
    label = cut_lineage(links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("label", F.col("node")))
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        low = cut_lineage(low)
        label = cut_lineage(label.join(low.withColumnRenamed("u", "label"), "label", "left").select("node", F.coalesce("m", "label").alias("label")))
        moved = links.join(low.select(F.col("u").alias("a"), F.col("m").alias("ma")), "a").join(low.select(F.col("u").alias("b"), F.col("m").alias("mb")), "b")
        moved = moved.filter("ma <> mb").select(F.least("ma", "mb").alias("a"), F.greatest("ma", "mb").alias("b"))
        links = cut_lineage(moved.distinct())
    return label
