"""Connected components of an edge table, by alternating large-star and small-star steps.

Nothing but convergence counts reaches the driver. A star's centre may have any number of neighbours: minima are
aggregated before the shuffle, and the join that brings them back can be split by adaptive execution, as its other
side has one row per node. Each round is written to the shared folder, so that a lost executor costs
one round, and the round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import removed, written

#: Edges are few beside what they were found in: one file for so many shuffle partitions.
SMALL = 16


def _large_star(e: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of the node and its neighbours."""
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them; edges come with ``u > v``."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``edges`` (columns ``u``, ``v`` of one ordered type) to (``node``, ``component``), the least node reachable.

    Only nodes with an edge to another node appear. Null ends, loops and repeated edges have no effect; an empty
    table gives an empty one.
    """
    e, path = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", SMALL)
    before = None
    while True:
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before or not now["n"]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before, last = now, path
        e, path = written(_small_star(_large_star(e)), "edges", SMALL)
        removed(edges.sparkSession, last)
