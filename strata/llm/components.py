"""Connected components of an edge table, as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, stored


def _toward_least(pairs: DataFrame) -> DataFrame:
    """Every (u, v) with the least of u and its neighbours: columns u, v, m."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").withColumn("m", F.least("u", "m"))


def _round(edges: DataFrame) -> DataFrame:
    """Large star, then small star: each neighbour points to the least one around."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    large = _toward_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .where("u > v").distinct()
    small = _toward_least(large)
    return small.select(F.explode(F.array(
        F.struct(F.col("u").alias("a"), F.col("m").alias("b")),
        F.struct(F.col("v").alias("a"), F.col("m").alias("b")))).alias("e")) \
        .select("e.*").where("a > b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge: the smallest node it can reach.

    Alternates large and small stars (the number of rounds grows with the logarithm
    of the longest chain). A round is one job: its edges are counted while they are stored, so
    a lost executor repeats one round at most, and the round before is removed then. Loops and
    nulls are ignored; nodes are of one orderable type."""
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct()
    seen = None
    with Scratch(edges.sparkSession) as scratch:
        while True:
            before = list(scratch.paths)
            edges, state = scratch.measured(edges, "edges", F.count("*").alias("n"),
                                            F.bit_xor(F.xxhash64("a", "b")).alias("h"))
            scratch.remove(before)
            if state == seen or not state["n"]:
                break
            seen, edges = state, _round(edges)
        return stored(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct(), "components")
