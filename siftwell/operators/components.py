"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame, cut: Callable[[DataFrame], DataFrame], left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is its smallest reachable node.

    Each round hooks every node to its smallest neighbour, follows these links to their ends and
    contracts the edges to what is left, so the edge table at least halves its nodes each time.
    No neighbour list is gathered; minima are pre-aggregated, so hubs cost no more than other nodes.
    Self-loops make single nodes; edges with a null end are ignored. cut stores a table and reads it
    again, which ends the lineage.
    """
    both = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a is not null and b is not null")
    roots = None
    rest = cut(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while not rest.isEmpty():
        sym = rest.union(rest.select("b", "a"))
        up = cut(sym.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("up")))
        while True:
            hop = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = cut(up.join(hop, "up", "left").select("node", F.coalesce("top", "up").alias("up"), (F.coalesce("top", "up") != F.col("up")).alias("moved")))
            up = jumped.select("node", "up")
            if jumped.where("moved").isEmpty():
                break
        if roots is None:
            roots = up
        else:
            step = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            roots = cut(roots.join(step, "up", "left").select("node", F.coalesce("top", "up").alias("up")))
        ends = up.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        other = up.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        rest = cut(
            rest.join(ends, "a").join(other, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        )
    if roots is None:
        return both.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return roots.select("node", F.col("up").alias("component"))
