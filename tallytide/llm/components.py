"""Connected components of an edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallytide.llm.common import written
from tallytide.operators.sizing import lookup_join


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    return (
        lookup_join(both, least, "u", rows="n")
        .filter("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them. Needs ``u > v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = (
        lookup_join(edges, least, "u", rows="n")
        .filter("v > m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the root is the smallest node it reaches.

    Alternates large and small stars until nothing changes, which takes about the logarithm of the
    longest path. The edge list never grows, lives in the shared folder between rounds, and only
    its count and a checksum reach the driver. Self links are dropped; nodes without another
    neighbour are not in the result, an empty list gives an empty table.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = written(edges.filter("u != v").distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        edges = written(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
