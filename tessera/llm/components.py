"""Connected components by alternating large-star and small-star steps.

Every step is one aggregation over the edges, whose hubs are pre-aggregated map-side, and
a join in which hubs stay where their edges are; edges go to the shared folder after each
round, so no lineage grows and no edge reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hot_join, materialize


def _stars(edges: DataFrame) -> DataFrame:
    """Each node linked to the smallest of its own and its neighbours' labels."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): for each node of the edges (a, b: long) the smallest node that it
    reaches. Edges from a node to itself and repeated edges do no harm; null ends drop
    out; no edges give no rows."""
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    while True:
        low = _stars(edges)
        # Large star: larger neighbours go to the smallest label around a node. Small
        # star: so do the node and its smaller neighbours.
        both = edges.select("a", "b").union(edges.select("b", "a"))
        moved = hot_join(both, low, "a").select(F.col("b").alias("x"), "m").union(low.select(F.col("a").alias("x"), "m"))
        new = moved.where("x <> m").select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct()
        new = materialize(new, "edges", replaces=[edges])
        # Done when every edge ends in a root: no node is both an upper and a lower end,
        # and none has two lower ends.
        ups = new.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        lower = new.select("b").distinct()
        rest = ups.where("n > 1").select("a").union(ups.select("a").join(lower, F.col("a") == F.col("b"), "left_semi"))
        edges = new
        if rest.isEmpty():
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)
