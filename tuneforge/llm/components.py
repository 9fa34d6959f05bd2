"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); a component is named by its smallest node.

    Each round moves every node to the smallest of itself and its neighbours and maps the edges along;
    stars collapse in one round, and rounds end when no edge is left. Edges, maps and labels are tables in
    the shared scratch folder; nothing is collected. A node with many edges is one group of a map-side
    combined minimum, and the joins are plain, so skewed ones can be split."""
    edges = written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("component", F.col("node"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        step = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("m"))
        step = written(step, "cc-step")
        labels = written(labels.join(step, labels["component"] == step["v"], "left")
                         .select("node", F.coalesce("m", "component").alias("component")), "cc-labels")
        moved = (edges.join(step, edges["a"] == step["v"]).select(F.col("m").alias("a"), "b"))
        moved = moved.join(step, moved["b"] == step["v"]).select("a", F.col("m").alias("b"))
        edges = written(moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    # The name a round settles on is the smallest node of its last star, so take the minimum of each component.
    least = labels.groupBy("component").agg(F.min("node").alias("_least"))
    return labels.join(least, "component").select("node", F.col("_least").alias("component"))
