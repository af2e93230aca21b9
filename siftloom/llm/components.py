"""Connected components by alternating large and small stars, each a pair of aggregates and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.llm.store import stored


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (or the node)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, move to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Columns ``u``, ``v`` (64-bit, any order, repeats allowed) to ``node``, ``root``: the least node it reaches.

    Nodes without edges are not listed. The rounds grow with the logarithm of the longest path; each is stored in the
    shared folder. No neighbourhood is gathered: hubs are split by partial aggregation and skew joins.
    """
    edges = stored(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(edges)
    while mark[0]:
        edges = stored(_small(_large(edges).distinct()).distinct())
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
