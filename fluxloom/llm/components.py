"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxloom.session import release, settle


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``); the root is the smallest node reachable.

    Large-star and small-star steps in turn: every node's neighbours are
    linked to the smallest node it sees, until nothing changes; the number of
    rounds grows with the logarithm of the number of nodes. The smallest
    neighbours are found by an aggregate, reduced before the shuffle, and
    written, so that the join beside it stays one whose skewed keys Spark
    splits: a node with very many links isn't one task. Only two numbers come
    to the driver each round.
    """
    edges = settle(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = settle(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        release(edges, least)
        least = settle(large.groupBy("u").agg(F.min("v").alias("m")))
        pairs = large.join(least, "u")
        small = pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = settle(small.where("u <> v").distinct())
        release(large, least)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
