"""Transitive closure of a child -> parent edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.storage import land


def role_closure(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """Every (child, ancestor) pair with its least depth.

    Breadth first: each round joins the newest pairs with the edges and drops
    pairs already known, so a diamond keeps its shortest path and a cycle ends.
    Rounds equal the depth of the hierarchy, and each round's pairs are landed,
    which keeps the plan short and survives a lost executor.
    """
    steps = land(
        edges.select(F.col(child).alias("child"), F.col(parent).alias("parent"))
        .filter("child IS NOT NULL AND parent IS NOT NULL")
        .distinct(),
        "edges",
    )
    fresh = steps.select("child", F.col("parent").alias("ancestor"), F.lit(1).alias("depth"))
    found, depth = [fresh], 1
    hop = steps.select(F.col("child").alias("ancestor"), F.col("parent").alias("__up"))
    while True:
        known = found[0]
        for part in found[1:]:
            known = known.union(part)
        reached = (
            fresh.join(hop, "ancestor")
            .select("child", F.col("__up").alias("ancestor"))
            .distinct()
            .join(known.select("child", "ancestor"), ["child", "ancestor"], "left_anti")
            .withColumn("depth", F.lit(depth + 1))
        )
        fresh = land(reached, "closure")
        if fresh.isEmpty():
            return known
        depth += 1
        found.append(fresh)
