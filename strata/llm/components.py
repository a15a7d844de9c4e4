"""Connected components over an edge table, by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node in ``edges`` (a, b); root is the smallest node reachable.

    Each round is two grouped minima and joins; the rounds grow with the
    logarithm of the longest path. A node's neighbours are never gathered: a hub
    only costs the rows of its edges, which the minimum pre-aggregates and the
    join may split. Every round is written to the shared folder.
    """
    both = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = scratch.save(both)
    state = None
    while True:
        # large star: every neighbour above u goes to the smallest node around u
        near = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = near.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        large = scratch.save(large.distinct())
        # small star: u and its lower neighbours go to the lowest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = scratch.save(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        sums = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(pairs)
        scratch.drop(large)
        pairs = after
        if tuple(sums) == state:
            break
        state = tuple(sums)
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
