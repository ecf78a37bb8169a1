"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.llm.common import join_facts, stash


def _smallest(edges: DataFrame) -> DataFrame:
    """(u, v) with the smallest of u's neighbourhood, u included. Nodes with very many neighbours, the centres of
    stars, are not joined in one task."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree"))
    least = stash(least.select("u", F.least("u", "m").alias("m"), "degree"), "stars")
    return join_facts(edges, least, "u", "degree").drop("degree")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    tied = _smallest(down)
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(tied.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node that an edge (u, v) touches; the root is the smallest node of its component.

    Each round is written to the shared folder and the steps end when the edges no longer change; a graph needs about
    as many rounds as the logarithm of its size. Only one row, a count and a sum, comes to the driver per round."""
    def tidy(df: DataFrame) -> DataFrame:
        return df.where("u <> v").distinct()

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    current = stash(tidy(edges.select("u", "v")), "edges")
    before = None
    for _ in range(rounds):
        now = mark(current)
        if now == before or not now[0]:
            break
        before = now
        current = stash(tidy(_small_star(_large_star(current))), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.unionByName(current.select(F.col("v").alias("node")).distinct()
                             .join(roots.select("node"), "node", "left_anti").withColumn("root", F.col("node")))
