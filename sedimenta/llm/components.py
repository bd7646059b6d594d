"""Connected components of an edge table, as joins and minima over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.scratch import materialize


def _settled(edges: DataFrame) -> bool:
    """Whether each node hangs on one node alone, which hangs on none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    ends = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return ends.where("hangs > 1 OR hangs = 1 AND holds = 1").isEmpty()


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest: the larger ones (large star) or the others."""
    both = edges.where("a > b")
    if large:
        both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = both.join(least, "a")
    if large:
        return hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    hung = hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the undirected edges (a, b): the smallest id it reaches.

    Alternates large and small stars until each node hangs on its root alone. Every step
    writes the edges anew, which cuts the plan; nothing of them reaches the driver but whether
    they are done. A node with many neighbours is a skewed join key, which Spark
    splits. Loops, doubles and null ends are ignored; no edges give no rows.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), (F.col("a") != F.col("b")).alias("ok"))
    edges = materialize(edges.where("ok").select("a", "b").distinct(), "edges")
    while not _settled(edges):
        edges = materialize(_starred(_starred(edges, large=True), large=False), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
