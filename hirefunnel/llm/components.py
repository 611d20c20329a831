"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirefunnel.llm.common import stored


def smallest_reachable(links: DataFrame) -> DataFrame:
    """From links a, b (numbers, a != b): node, root for every node but the roots.

    root is the smallest node that can be reached. Both steps only take a minimum over a node's
    neighbours, which is computed before the shuffle, and join it back; no list of neighbours
    is ever held. Each round is written, so that a lost executor costs one round at most.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc"
    )
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Large star: every larger neighbour of u points to the smallest of them all.
        edges = both.where("v > u").join(low, "u").where("v != m").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        edges = edges.distinct()
        # Small star: u and its smaller neighbours point to the smallest of these.
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        near = edges.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = near.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(edges, "cc")
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    """Number and order-independent sum of the edges: unchanged once every tree is a star."""
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed)).first())
