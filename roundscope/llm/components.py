"""Connected components by alternating star contraction, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundscope.llm.common import checkpointed


def _state(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is linked to the least of its neighbourhood."""
    both = pairs.select(F.col("hi").alias("node"), F.col("lo").alias("near")).union(
        pairs.select(F.col("lo").alias("node"), F.col("hi").alias("near"))
    )
    least = both.groupBy("node").agg(F.min("near").alias("near_min"))
    least = least.select("node", F.least("node", "near_min").alias("low"))
    linked = both.join(least, "node").where(F.col("near") > F.col("node"))
    return linked.select(F.col("near").alias("hi"), F.col("low").alias("lo")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, is linked to the least of them."""
    least = pairs.groupBy("hi").agg(F.min("lo").alias("low"))
    moved = pairs.join(least, "hi").where(F.col("lo") != F.col("low"))
    moved = moved.select(F.col("lo").alias("hi"), F.col("low").alias("lo"))
    return moved.union(least.select("hi", F.col("low").alias("lo"))).distinct()


def connected_components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, root) for every node of an edge that joins two different nodes; root is the least node reachable.

    Null ends and self links give nothing. A node's neighbours are never gathered: each step takes minima per
    node and joins them back, so a component of any size stays spread over the rows of its links. The number of
    rounds grows with the logarithm of the longest path; each is cut off by a checkpoint.
    """
    a, b = F.col(left), F.col(right)
    pairs = edges.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    pairs = checkpointed(pairs)
    state = _state(pairs)
    while state[0]:
        following = checkpointed(_small_star(_large_star(pairs)))
        after = _state(following)
        pairs = following
        if after == state:
            break
        state = after
    nodes = pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return nodes.union(pairs.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
