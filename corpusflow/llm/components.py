"""Connected components of a link table, without bringing links to one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.plans.sizing import materialise


def _star(links: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Re-hang the neighbours of every node on the least of them."""
    least = neighbours.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return neighbours.join(least, "u")


def connected(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(u, v)``; the root is the least node reachable.

    Alternating large-star and small-star steps: each step hangs nodes on the least neighbour,
    so the diameter shrinks fast, and no step makes more links than it was given. A node with
    very many links is only ever grouped by a combined minimum and joined, where a skewed key
    is split. Every round is checkpointed.
    """
    links = links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = materialise(links.distinct())
    seen = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(links, both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        hung = _star(large, large)
        small = (hung.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
                 .unionByName(hung.select("u", F.col("m").alias("v")).distinct()))
        links = materialise(small.where("u != v").distinct())
    roots = links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
