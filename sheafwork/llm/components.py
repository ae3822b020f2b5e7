"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.jobs import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node reachable from each node that has an edge: ``node``, ``root``.

    Star contraction: every node's neighbours are pointed at the smallest of
    them, first those above the node, then those below, until only stars are
    left. Neighbourhoods are aggregated and joined, never collected. Each round
    is written to the shared folder.
    """
    current = stage(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    while True:
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: each node and its smaller neighbours point at the smallest.
        down = large.where("u <> v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(
            least.select("u", F.col("m").alias("v"))
        )
        following = stage(small.distinct(), "edges")
        # Stars: every node points at one node, which points nowhere.
        left = following.join(following.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count()
        if not left:
            break
        current = following
    pointed = following.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pointed.union(pointed.select(F.col("root").alias("node"), "root").distinct())
