"""Connected components of an edge table by alternating stars (Kiveris et
al., "Connected Components in MapReduce and Beyond", 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.storage import materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge to another; ``root`` is the
    smallest node of its component.

    Each round is written to the shared folder; rounds grow with the logarithm
    of the longest chain.  Neighbour minima are partial aggregates joined
    back, so a hub of a component is split like any skewed join key.
    """
    spark = edges.sparkSession
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    now = materialise(spark, edges.where(x != y).select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo")).distinct(),
                      "edges")
    state = _state(now)
    while state[0]:
        now = materialise(spark, _small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _state(edges: DataFrame):
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first()
    return r[0], r[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the least of its neighbourhood."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie the smaller neighbours of a node, and the node, to the least of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    rest = edges.join(least, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return rest.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()
