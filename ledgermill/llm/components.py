"""Connected components of an edge table, by alternating large and small stars.

A large star links each larger neighbour of a node to the smallest node around it, a small star
does the same with the node and its smaller neighbours. The number of edges never grows, and the
edges end as stars around the smallest node of each component. Each round reads a written table,
so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.session import written

EDGE = "a long, b long"


def _smallest(pairs: DataFrame) -> DataFrame:
    """For each node ``u`` of (u, v) the smallest node around it, itself included; combined before the shuffle."""
    return written(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star-minima")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.selectExpr("a as u", "b as v").union(edges.selectExpr("b as u", "a as v"))
    larger = both.where("v > u").join(_smallest(both), "u")
    return larger.selectExpr("v as a", "m as b").where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.selectExpr("greatest(a, b) as u", "least(a, b) as v")
    near = down.join(_smallest(down), "u")
    ends = near.selectExpr("v as a", "m as b").union(near.selectExpr("u as a", "m as b"))
    return ends.where("a != b").distinct()


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    row = edges.agg(F.count("*"), F.sum(mixed.cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of an edge.

    Edges may repeat, run in either direction or join a node to itself; edges with a null end are
    left out. No edges: no rows.
    """
    links = edges.select(edges[a].cast("long").alias("a"), edges[b].cast("long").alias("b"))
    links = links.where("a is not null and b is not null")
    loops = links.where("a = b").selectExpr("a as node", "a as component")
    current = written(links.where("a != b").distinct(), "edges")
    before = _state(current)
    while before[0]:
        current = written(_small_star(_large_star(current)), "edges")
        after = _state(current)
        if after == before:
            break
        before = after
    nodes = current.selectExpr("a as node", "b as component").union(current.selectExpr("b as node", "b as component"))
    return nodes.union(loops).groupBy("node").agg(F.min("component").alias("component"))
