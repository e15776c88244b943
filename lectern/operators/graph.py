"""Connected components of a graph given as edges, by alternating large and small stars.

Each round makes every node's neighbours point at the smallest node around it; a few rounds turn each component into a star.
Edges stay distributed, rounds are written to the shared folder, and a node with very many edges is only ever aggregated with
partial sums and joined, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.plans.workspace import materialize

MOST_ROUNDS = 60


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b), of any orderable type: (node, component) for each node that has an edge to another; component is the
    smallest node. Loops, repeated edges and nulls are ignored; no edges, no rows."""
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e, last = materialize(e, "edges"), None
    for _ in range(MOST_ROUNDS):
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == last or not now[0]:
            break
        last = now
        e = materialize(_small_star(_large_star(e)).distinct(), "edges")
    else:
        raise RuntimeError("the components did not settle")
    stars = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
