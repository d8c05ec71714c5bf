"""Connected components by alternating star steps on plain joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasift.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step. The least neighbour comes from a combinable minimum, so a hub's edges are never
    gathered; the join back has one row per node on one side and can be split on the other."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:  # toward the smaller end only
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
    joined = both.join(least, F.col("a") == F.col("n"))
    if large:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of the edges ``(a, b)``; root is the least node of the component.

    Each round writes its edges to the shared checkpoint folder, so plans stay flat and a lost executor
    costs tasks, not rounds. It ends when every edge points at a root that is no one's child.
    """
    edges = materialize(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    for _ in range(max_rounds):
        edges = materialize(_star(_star(edges, True), False), "edges")
        # settled: each node has one edge, and its end has none
        state = edges.groupBy(F.col("a").alias("n")).agg(F.count("*").alias("c"))
        many = state.filter("c > 1").select("n").unionByName(
            edges.select(F.col("b").alias("n")).distinct().join(state.select("n"), "n", "left_semi"))
        if many.limit(1).count() == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
