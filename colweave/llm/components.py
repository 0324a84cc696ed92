"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.llm.tables import discard, settle_few

# Edges that one task can take: up to here a round needs no exchange, beyond it the same round runs by shuffle.
ONE_TASK_EDGES = 200_000


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame) -> DataFrame:
    """(u, v, m): every neighbour v of u with the smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(least, "u")


def _tidy(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("u") != F.col("v")).distinct()


def _at_rest(edges: DataFrame) -> bool:
    """Whether every node hangs on one other that hangs on none: then the edges are stars around the smallest nodes."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    sums = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return sums.where("hangs > 1 or (hangs = 1 and holds = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (u, v).

    The component is the smallest node reachable. Null ends, loops and repeated
    edges are allowed and add nothing; without edges the result is empty. Each
    half-step only sends a node's edges to the smallest neighbour, so the
    number of edges never grows, minima are combined map-side, and a star of
    any size is finished in one round. Every round is written to the shared
    folder, and the last one gone is deleted.
    """
    ends = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull())
    now = settle_few(_tidy(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "edges", ONE_TASK_EDGES)
    while not _at_rest(now):
        large = _star(_both_ways(now)).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Every edge now points from the larger to the smaller end.
        small = _star(_tidy(large))
        hung = small.select("v", "m").union(small.select(F.col("u").alias("v"), "m"))
        after = settle_few(_tidy(hung.select(F.col("v").alias("u"), F.col("m").alias("v"))), "edges", ONE_TASK_EDGES)
        discard(now)
        now = after
    # At rest every node hangs on the smallest of its component.
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
