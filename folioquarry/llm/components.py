"""Connected components of a graph of documents, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, written, written_small


def components(edges: DataFrame) -> DataFrame:
    """(node, component) from edges (a, b): the least node that each node of an edge reaches.

    Each round replaces the edges by ones to least neighbours: a node's greater neighbours, and then
    its lesser ones, are tied to the least of all. Rounds grow with the logarithm of the longest
    path; a round sends each edge twice, minima are reduced before they shuffle, and no node's
    neighbours are gathered: minima are written first, so few of them are broadcast, and where they are many
    both sides of the join are dealt anew and Spark splits the edges of a node that has too many.
    Each round is written, so a lost executor costs one round at most.

    Edges from a node to itself, repeated edges and their direction change nothing; nodes without an edge to another are not in the result; edges with a
    null end are left out; no edges give no rows; further columns are not read.
    """
    with scratch(edges.sparkSession):
        stars = written(_stars(edges), keep=True)
    return stars.select(F.col("b").alias("node"), F.col("a").alias("component")).union(stars.select("a", "a").distinct())


def _stars(edges: DataFrame) -> DataFrame:
    """Edges (a, b) from the least node of each component to its others."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = written(edges.where("a <> b").select(low.alias("a"), high.alias("b")).distinct())
    while True:
        # large star: greater neighbours to the least neighbour
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = written_small(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        large = written(large)
        # small star: lesser neighbours and the node itself to the least neighbour
        least = written_small(large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m")))
        tied = large.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least, "u")
        edges = written(tied.select(F.col("m").alias("a"), F.col("v").alias("b")).union(least.select("m", "u")).where("a <> b").distinct())
        # done when no node is both a head and a member, nor a member twice: all are stars
        ends = edges.select("b").union(edges.select("a").distinct())
        if ends.groupBy("b").count().where("count > 1").isEmpty():
            return edges
