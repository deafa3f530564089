"""Connected components by alternating large-star and small-star steps, at every size alike.

A large star ties every larger neighbour of a node to the smallest node of its neighbourhood, a small star ties the smaller ones.  A
star's centre may have any number of neighbours: its minimum is pre-aggregated before the shuffle and joined back, so no neighbourhood
is gathered in a task.  The steps go on until every node points at one that points at none; each writes its edges to the shared folder,
so a lost executor costs one step at most.

Links with a null end and links of a node with itself tie nothing; repeated links count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import free, staged


def _settled(edges: DataFrame) -> bool:
    """Whether edges(u, v) are stars: no node points at two others, or at one and is pointed at."""
    out = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in"))
    ends = out.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in")).where("out > 1 OR (out = 1 AND in = 1)").isEmpty()


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """links(x, y) of longs to one row (node, component) for each node of a link; component: the smallest node reachable.

    rounds: more of them are an error; by default there is no limit.
    """
    edges = staged(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("x IS NOT NULL AND y IS NOT NULL AND u <> v").distinct(), "edges")
    turn = 0
    while not _settled(edges):
        if turn == rounds:
            raise RuntimeError(f"components have not settled after {rounds} rounds")
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        before, edges = edges, staged(small.where("u <> v").distinct(), "edges")
        free(before)
        turn += 1
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
