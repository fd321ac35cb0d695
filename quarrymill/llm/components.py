"""Connected components by alternating large and small stars, written each round.

Every step is an aggregate and a join on one node, so that a node with very
many neighbours is pre-aggregated and its rows are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import dropped, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges(u, v), u > v.  Large: a node's greater neighbours join its least one; small: the lesser and itself do."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = near.join(least, "u")
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges(u long, v long)`` -> ``(id, group)`` for every node of an edge; ``group`` is the least id of its component.

    Self-loops and repeated edges don't matter; no edges, no rows.  The rounds
    end when nothing changes, after about the square of the logarithm of the nodes.
    """
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "edges")
    mark = None
    while True:
        after = written(_star(_star(now, True), False), "edges")
        total = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        dropped(now)
        now = after
        if total == mark:
            break
        mark = total
    leaves = now.select(F.col("u").alias("id"), F.col("v").alias("group"))
    return leaves.unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("group")).distinct())
