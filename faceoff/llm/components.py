"""Connected components by alternating star contraction, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faceoff.llm.common import written


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the node's least neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them (u > v holds)."""
    least = _least_neighbour(edges)
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: longs); root is the least node reachable.

    Each round is a few joins and map-side combined aggregates whose size is
    the number of edges, never a group gathered in one place; a popular node
    is a skewed join key, which AQE splits.  Rounds end when nothing moves.
    Only two numbers a round come to the driver.
    """
    star = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    star = written(star, "cc")
    state = _state(star)
    while state[0]:
        star = written(_small_star(_large_star(star).distinct()).distinct(), "cc")
        now = _state(star)
        if now == state:
            break
        state = now
    nodes = star.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(star.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
