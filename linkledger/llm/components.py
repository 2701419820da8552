"""Connected components of a table of links, by alternating large and small stars.

Every round points nodes to smaller neighbours, so paths shrink by about half a round; rounds are written tables, and
nothing but counts reaches the driver. A node with very many links is summed before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkledger.llm.common import Stages


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.selectExpr("b as a", "a as b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) as m")
    return both.filter("b > a").join(least, "a").selectExpr("b as a", "m as b").filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.selectExpr("greatest(a, b) as a", "least(a, b) as b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").selectExpr("b as a", "m as b").filter("a <> b")
    return moved.unionByName(least.selectExpr("a", "m as b")).distinct()


def joined(labels: DataFrame, links: DataFrame, stages: Stages, name: str) -> DataFrame:
    """``labels`` (node, component; every node once) after more ``links`` (a, b): rounds run on the components that the
    links join, and not on their members again."""
    ends = links.join(labels.selectExpr("node as a", "component as x"), "a").join(
        labels.selectExpr("node as b", "component as y"), "b")
    pairs = stages.write(ends.filter("x <> y").selectExpr("least(x, y) as a", "greatest(x, y) as b").distinct(), f"{name}-ends")
    if pairs.isEmpty():
        return labels
    moved = components(pairs, stages, f"{name}-round").selectExpr("node as component", "component as least")
    return labels.join(moved, "component", "left").selectExpr("node", "coalesce(least, component) as component")


def components(links: DataFrame, stages: Stages, name: str) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b; both long): the component is its smallest node."""
    edges = links.filter("a <> b").select("a", "b").distinct()
    mark, n = None, 0
    while True:
        edges = stages.write(_small_star(_large_star(edges)), f"{name}-{n}")
        found = edges.selectExpr("count(*)", "sum(cast(xxhash64(a, b) as decimal(38, 0)))").first()
        if n:
            stages.drop(f"{name}-{n - 1}")
        if (found[0], found[1]) == mark:
            break
        mark, n = (found[0], found[1]), n + 1
    return edges.selectExpr("a as node", "b as component").unionByName(
        edges.selectExpr("b as node", "b as component").distinct())
