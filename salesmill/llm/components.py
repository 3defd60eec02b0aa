"""Connected components of a graph that Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from salesmill.session import written


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b): the smallest node it can reach.

    Each round links every node's larger neighbours, then its smaller ones, to the smallest it
    knows, which leaves stars after about log(n) rounds. Rounds are written, so a lost executor
    costs one of them; a hub is aggregated by min before its row is used.
    """
    edges = written(links.select("a", "b").where("a <> b").distinct(), "links")
    total = None
    while True:
        both = edges.select("a", "b").union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        least = least.select("a", F.least("a", "least").alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = written(small.union(down).where("a <> b").distinct(), "stars")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == total:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        total = tuple(state)
