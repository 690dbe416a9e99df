"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curblake.llm.common import release, spool


def components(links: DataFrame) -> DataFrame:
    """links(a, b) -> (node, component) of every node with a link; component: the smallest node reachable.

    Large star: each node hands its larger neighbours to the smallest of its neighbourhood; small star:
    it hands its smaller neighbours, and itself, to the smallest.  Both keep the components, and the
    table ends as one star a component after about log(nodes) rounds, however long a chain is.  Each
    round groups and joins on single nodes only, and is written before the next.
    """
    edges = spool(links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.where(F.col("b") > F.col("a")).join(low, "a").select("low", F.col("b").alias("high"))
        large = spool(large.where(F.col("low") != F.col("high")).distinct(), "large-star")
        low = large.groupBy("high").agg(F.min("low").alias("lowest"))
        small = large.join(low, "high").select(F.col("lowest").alias("a"), F.explode(F.array("low", "high")).alias("b"))
        after = spool(small.where(F.col("a") != F.col("b")).distinct(), "small-star")
        release(edges, large)
        edges, now = after, after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct()
        seen = now
