"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise




def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long, not null).

    ``component`` is the smallest node reachable.  Each round writes its
    edges, so lost executors cost at most one round; a hub's edges are split
    by the skew join, because both sides of every join are written tables.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    edges = materialise(links.filter("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "edges")
    while True:
        # large star: every neighbour above a node points to the node's lowest neighbour
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low")), "lows")
        large = both.join(low, "a").filter("b > a").select(F.col("low").alias("a"), "b").distinct()
        large = materialise(large, "large-star")
        # small star: a node and its lower neighbours point to the lowest of them
        low = materialise(large.groupBy("b").agg(F.min("a").alias("low")), "lows")
        joined = large.join(low, "b")
        small = joined.select(F.col("low").alias("a"), F.explode(F.array("a", "b")).alias("b")).filter("a < b").distinct()
        small = materialise(small, "small-star")
        changed = edges.join(small, ["a", "b"], "left_anti").limit(1).count() + small.join(edges, ["a", "b"], "left_anti").limit(1).count()
        edges = small
        if not changed:
            break
    roots = edges.select(F.col("a").alias("node")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
