"""Connected components of a graph of long ids, by alternating large and small stars.

Each round is two joins and two aggregations over the edges; ids are never collected. A node with a third of all edges
is one row per task after the first aggregation, and its join is split by adaptive skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitymill.llm.work import kept


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``a``, ``b`` to ``node``, ``root``: every node of an edge, with the smallest id of its component.

    Loops, nulls and repeated edges are ignored. Raises if it has not settled after ``max_rounds``, which a number of
    nodes far beyond any store would take.
    """
    tied = edges.filter(F.col("a") != F.col("b"))
    now = kept(tied.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(now)
    for _ in range(max_rounds):
        now = kept(_small_star(_large_star(now)), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
            return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest among the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    joined = both.filter(F.col("b") > F.col("a")).join(least, "a")
    return joined.select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these; edges lead from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.filter(F.col("a") != F.col("b")).unionByName(least.toDF("a", "b")).distinct()
