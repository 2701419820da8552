"""Groups of rows that links connect, directly or through others."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

Stage = Callable[[DataFrame, str], DataFrame]


def _to_least(edges: DataFrame, start: str) -> DataFrame:
    """(node, other, least): the links of every node with the least of its neighbours and itself, counted before they
    meet the links, so that a node with very many is one row when it does."""
    least = edges.groupBy("node").agg(F.expr("min(other) AS neighbour")).selectExpr("node", f"{start} AS least")
    return edges.join(least, "node")


def connected(links: DataFrame, stage: Stage) -> DataFrame:
    """(node, least) of every node of ``links`` (a, b): the least node that it is connected with, itself included.

    Links point to ever smaller nodes. A round first hangs the larger neighbours of each node below the least one, then
    the smaller ones and the node itself; chains shrink by about half a round, and stars stay as they are. Each round is
    written, and nothing but its size reaches the driver.
    """
    edges = stage(links.filter("a <> b").selectExpr(
        "greatest(a, b) AS node", "least(a, b) AS other").distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.selectExpr("other AS node", "node AS other"))
        hung = _to_least(both, "least(node, neighbour)").filter("other > node").selectExpr(
            "other AS node", "least AS other").filter("node <> other").distinct()
        low = _to_least(hung, "neighbour")
        moved = low.filter("other <> least").selectExpr("other AS node", "least AS other")
        edges = stage(moved.unionByName(low.selectExpr("node", "least AS other")).distinct(), "rounds")
        found = edges.selectExpr("count(*)", "sum(cast(xxhash64(node, other) AS decimal(38, 0)))").first()
        if tuple(found) == mark:
            break
        mark = tuple(found)
    roots = edges.select("other").distinct()
    return edges.selectExpr("node", "other AS least").unionByName(roots.selectExpr("other AS node", "other AS least"))
