"""Connected components of an edge table: large-star and small-star steps, each written before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import written


def components(edges: DataFrame, folder: str, most: int = 100) -> DataFrame:
    """``edges`` (a, b) to one row per node (node, root), where root is the smallest node of the component.

    A step replaces a node's edges by edges to its smallest neighbour; the number of edges never grows. A node with
    very many edges is one row per task in the minimum, and its rows in the join are split by the planner.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), folder, "edges-0")
    for step in range(1, most + 1):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        # large star: the larger neighbours of a node go to the least of its neighbourhood
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b").distinct()
        )
        large = written(large, folder, f"large-{step}")
        # small star: a node and its smaller neighbours go to the least of these
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("a", "m")).distinct()
        )
        new = written(small, folder, f"edges-{step}")
        # settled: every node has one edge, to a node that has none
        if new.groupBy("a").count().where("count > 1").isEmpty() and new.join(new.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            roots = new.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
            return new.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
        now = new
    raise RuntimeError(f"components not settled after {most} steps")
