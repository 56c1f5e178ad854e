"""Connected components by alternating large and small stars, in Spark throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pizarra.llm.common import written


def _large(edges: DataFrame) -> DataFrame:
    """Hang every greater neighbour of a node on the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, root`` of every node with an edge in ``edges (u, v)``, except the roots
    (each component's smallest node).  Edges are summed up in each task before they
    move; every round is a written table, and the last is one of stars only: every
    node has one root, which has none itself."""
    now = edges.select("u", "v").where("u <> v")
    for _ in range(max_rounds):
        now = written(_small(_large(now)), "stars")
        twice = now.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
        if twice.isEmpty() and now.join(now.select(F.col("v").alias("u")), "u", "left_semi").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
