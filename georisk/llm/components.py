"""Connected components of an edge table, by alternating stars.

Large-star links every larger neighbour of a node to the node's smallest
neighbour, small-star links the smaller ones; the two alternate until the edge
table no longer changes, when each component is a star around its smallest
node.  Both steps are one aggregation and one equi-join, so nothing about a
component is ever gathered in a task or in the driver, and a hub is split by
adaptive skew handling like any other frequent join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges are (u, v) with v < u: link u and its smaller neighbours to the smallest."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (edges.join(least, "u").filter("v <> m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return least.select("u", F.col("m").alias("v")).unionByName(moved).distinct()


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``links(u, v)`` of longs -> ``(node, root)``, root the smallest node reachable.

    Nodes without a link to another node are not listed.  Null ends and loops
    are ignored; repeated and reversed links count once.  ``max_rounds`` only
    guards against an endless loop: it raises, it never returns early.
    """
    edges = cut_lineage(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links")
    before = _state(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        edges = cut_lineage(_small_star(_large_star(edges)), "stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
