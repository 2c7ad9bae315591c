"""Connected components of an edge table by alternating large and small stars.

Every round points the larger neighbours of a node at its smallest neighbour
(large star), then the smaller ones (small star).  Edge counts never grow beyond
nodes and edges given; rounds are written to the shared folder, so lineage stays
short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.shared import materialize


def star(edges: DataFrame) -> DataFrame:
    """One large and one small star; ``edges``: u > v, distinct."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (both.filter("v > u").join(least, "u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    down = large.groupBy("u").agg(F.min("v").alias("m"))
    small = (large.join(down, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(down.select("u", F.col("m").alias("v"))))
    return small.distinct()


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """node, component (smallest node reachable) for every node with an edge."""
    now = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                      .filter("u > v").distinct(), "edges")
    for _ in range(max_rounds):
        after = materialize(star(now), "edges")
        # a forest of stars: every node has one parent and no parent has one
        if after.join(after.select(F.col("u").alias("v")), "v", "left_semi").isEmpty() and \
                after.groupBy("u").count().filter("count > 1").isEmpty():
            return (after.select(F.col("u").alias("node"), F.col("v").alias("component"))
                    .unionByName(after.select("v", F.col("v").alias("c")).distinct()
                                 .toDF("node", "component")))
        now = after
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
