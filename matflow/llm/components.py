"""Distributed connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matflow.llm.storage import stored

#: Rounds after which the search gives up; the number needed grows with the logarithm of a component's diameter.
MOST_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); a component is named by its least node.

    Alternates large-star and small-star steps until the edges no longer change. Every step takes minima with
    partial aggregation and one join on the node, whose hot keys adaptive execution splits; no node's neighbours
    are ever gathered.
    """
    edges = _pointing_down(edges.select("a", "b"))
    for _ in range(MOST_ROUNDS):
        edges = stored(_small_star(_large_star(edges)), "edges")
        if _settled(edges):
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node points to one other and no node that is pointed to points on."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    degrees = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return degrees.filter(F.col("out") + F.col("in") > 1).isEmpty()


def _pointing_down(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node to the smaller one."""
    ordered = edges.filter(F.col("a") != F.col("b"))
    return ordered.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node point to the least of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("v"))
    # Repeated edges are left to the next step.
    return larger.join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _pointing_down(joined.union(least.select("a", F.col("m").alias("b"))))
