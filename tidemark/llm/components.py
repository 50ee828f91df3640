"""Connected components of a graph that no single task holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): root is the smallest node it reaches.

    Alternates the large-star and small-star steps until the edges stop changing; each
    step is a grouped minimum and a join back, so a node with many links is pre-aggregated
    and never gathered. The edges are written out between rounds.
    """
    edges = staged(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        edges = staged(_small_star(_large_star(edges)), "edges")
        # a sum over hashes of all edges tells whether a round changed any
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets the node's smallest neighbour."""
    sides = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    least = sides.groupBy("node").agg(F.min("other").alias("m")).select(
        F.col("node").alias("n"), F.least("node", "m").alias("m"))
    return (sides.filter("other > node").join(least, F.col("node") == F.col("n"))
            .select(F.col("other").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, gets the node's smallest neighbour."""
    edges = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    least = edges.groupBy("node").agg(F.min("other").alias("m")).select(F.col("node").alias("n"), "m")
    moved = edges.join(least, F.col("node") == F.col("n")).select(F.col("other").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("n").alias("a"), F.col("m").alias("b"))
    return moved.union(own).filter("a != b").distinct()
