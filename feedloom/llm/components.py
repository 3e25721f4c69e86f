"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, join_hot, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for each node of the links the smallest node that it reaches.

    Alternates large and small stars: every node hands its larger, then its
    smaller neighbours to the smallest one, until each component is one star.
    Each round is a written table in the place of the one before; edges stay in the executors. The smallest
    neighbour is a minimum after Spark's partial aggregate; those of nodes with
    very many edges, a bounded number, are broadcast to the edges.
    """
    edges = written(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct(), "edges")
    before, total = None, edges.count()
    while total:
        large = written(_large_star(edges, total), "large")
        dropped(edges)
        edges = written(_small_star(large, total), "stars")
        dropped(large)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, total = state, state[0]
    nodes = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.unionByName(edges.groupBy("a").agg(F.first("a").alias("component")).withColumnRenamed("a", "node"))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count(F.lit(1)).alias("n"))
    return join_hot(both.where("b > a"), least, "a", total).select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    # Here edges go from the larger node to its smaller neighbours.
    least = edges.groupBy("b").agg(F.min("a").alias("m"), F.count(F.lit(1)).alias("n"))
    moved = join_hot(edges, least, "b", total).where("a <> m").select(F.col("m").alias("x"), F.col("a").alias("y"))
    own = least.select(F.col("m").alias("x"), F.col("b").alias("y"))
    return moved.unionByName(own).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
