"""Connected components of an undirected graph given as edges, by alternating
large-star and small-star steps.

Each step replaces a node's edges by edges to the smallest node it sees, so long
chains halve and a hub becomes a star.  Minima are partial aggregates and the
edges are joined to them, a join Spark can split on a hot node.  Every round is a
written table in shared storage, so no lineage grows and a lost executor costs a
re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` (the component's smallest node) of every node with an edge to
    another.  Null ends and loops are dropped; repeated edges don't matter."""
    e = materialize(edges.where(F.col(a) != F.col(b))
                    .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    state = None
    while True:
        now = tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == state or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now
        e = materialize(_small_star(_large_star(e)), "edges")
