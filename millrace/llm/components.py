"""Connected components by alternating large and small stars.

Each round hangs every node below the smallest node it knows, with joins and
partial aggregates only; a hub's edges are one side of a join, which Spark
splits. Rounds are written to the shared folder, so that no lineage grows and a
lost executor costs one round at most; a round's files go when the next is written. Nothing is collected but two numbers a
round, which tell whether it changed anything.

A round is several jobs, whose plans and compiled code fill the driver however few the edges are. So one task
finishes what has at most ``AT_ONCE`` edges, a bound that doesn't follow the input; more edges take rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.storage import discard, land

AT_ONCE = 1 << 19
_EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64())])
_EDGE_SQL = "u long, v long"


def least_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of a graph, sorted, and for each the smallest one reachable."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while (root[a] != root[b]).any():
        least = np.minimum(root[a], root[b])
        for side in (root[a], root[b]):
            np.minimum.at(root, side, least)
        while (root != root[root]).any():
            root = root[root]
    return nodes, nodes[root]


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node but the smallest of its component, below that one."""
    parts = [[b[c].to_numpy() for c in ("u", "v")] for b in batches]
    if parts:
        nodes, roots = least_reachable(*(np.concatenate(x) for x in zip(*parts)))
        hung = nodes != roots
        yield pa.RecordBatch.from_arrays([pa.array(nodes[hung]), pa.array(roots[hung])], schema=_EDGE)


def _digest(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    down = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(joined.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node that has
    an edge to another one and isn't itself the root. Loops, nulls and repeated
    edges are allowed; no edges give no rows."""
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    proper = edges.filter((F.col(a) != F.col(b))).select(u, v).distinct()
    now = land(proper, "edges", free=True)
    before = _digest(now)
    while before[0]:
        small = before[0] <= AT_ONCE
        further = now.coalesce(1).mapInArrow(_finished, _EDGE_SQL) if small else _small_star(_large_star(now))
        last, now = now, land(further, "edges", free=True)
        after = None if small else _digest(now)
        discard(last)
        if small or after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
