"""Connected components of a graph given by edges, as alternating star operations in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adrlens.llm.common import discard, written
from adrlens.session import intermediates


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Edges (a, b, least): least of a and all its neighbours."""
    least = written(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least")
    return edges.join(least, "a")  # both sides are scans: a node with many edges can be split


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (_least_neighbour(both).where("b > a")
            .select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    linked = _least_neighbour(down)
    ends = linked.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return (ends.unionByName(linked.select("a", F.col("least").alias("b")))
            .where("a != b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node that edges (a, b) lead to.

    Nodes without edges are left out.  Large and small stars alternate until each node points at
    the least of its component; every round is written, so a lost executor costs one round.  A
    node with very many edges is joined with one row, which adaptive execution can split.
    """
    spark = edges.sparkSession
    edges = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "edges")
    state = None
    while True:
        before = edges
        with intermediates(spark):
            edges = written(_small_star(_large_star(before)), "edges", result=True)
        discard(before)
        found = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if found == state:
            break
        state = found
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
