"""Connected components of an edge table by distributed union-find (DataFrame joins only).

Alternating star contraction: a *large star* hooks every larger neighbour of a node to the
node's smallest neighbour, a *small star* hooks the smaller neighbours of a node to the
smallest of them.  Every step keeps the components and shortens paths; the table ends as
stars around the smallest node of each component, after O(log^2 n) rounds.  A round writes
its edges to the shared folder and reads them back, so lineage stays short and a lost
executor repeats one round; the edges of the round before are removed.  Only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize


def _directed(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _directed(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.join(least, "a").filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hooked = down.join(least, "a")
    return (hooked.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .filter("a != b").distinct())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node that has a link to another node.

    ``edges`` has columns ``a`` and ``b`` of one orderable type, in any direction, repeats and
    loops allowed (a loop alone gives no row).  Rows with a null end are ignored.
    ``component`` is the smallest node reachable.  An empty table gives an empty table.
    """
    now = materialize(edges.select("a", "b").filter("a != b").distinct(), "components")
    mark = _fingerprint(now)
    if mark[0] == 0:
        return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(max_rounds):
        before, now = now, materialize(_small_star(_large_star(now)), "components")
        discard(before)
        new = _fingerprint(now)
        if new == mark:
            pairs = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            roots = pairs.select(F.col("component").alias("node"), "component").distinct()
            return pairs.union(roots)
        mark = new
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _fingerprint(edges: DataFrame) -> tuple:
    """Edge count and an order-free sum of edge hashes: equal when a round changed nothing."""
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]
