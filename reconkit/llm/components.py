"""Connected components by alternating star steps; every round is two joins on the links that are left.

Links get as many tasks as their number asks for, however many partitions a shuffle has:
few links go through all rounds in few tasks and files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reconkit.llm.common import joined_up, stored, tasks_for

LINKS = 1 << 14  # in a task


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour."""
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = edges.select(F.inline(ends))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return joined_up(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")), tasks)


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the smallest of them; links run from large to small."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    # the link to the smallest one stands for the node itself
    moved = F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
    return joined_up(joined_up(edges.join(least, "a").select(moved.alias("a"), F.col("m").alias("b")), tasks).distinct(), tasks)


def _unsettled(edges: DataFrame, tasks: int) -> int:
    """Nodes with several links to smaller ones, or with links to both sides; none if all is stars."""
    ends = F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return joined_up(nodes.filter("up > 1 or up = 1 and down = 1"), tasks).count()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the smallest node) for every node of ``links`` (stored: they are counted first); self-links are dropped.

    Each round is written to the shared folder; rounds grow with the logarithm of the longest path.
    """
    tasks = tasks_for(links.count(), LINKS)  # a round never makes more links
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b")
    while True:
        edges = joined_up(edges, tasks)
        edges = joined_up(stored(_small_star(_large_star(edges, tasks), tasks), "stars"), tasks)
        if not _unsettled(edges, tasks):
            break
    ends = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("component")), F.struct(F.col("b").alias("node"), F.col("b").alias("component")))
    return joined_up(edges.select(F.inline(ends)).distinct(), tasks)
