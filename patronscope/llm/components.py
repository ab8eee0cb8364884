"""Connected components of a graph given as an edge table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .staging import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (columns a, b): the smallest node that can be reached.

    Each round takes the smallest label among the neighbours and then the label of that label, so distances at least
    halve. A node with very many edges is one aggregated row on the label side and many rows on the edge side, which
    adaptive execution splits. Every round is written to the shared folder; the rounds end when no label changes.
    """
    both = staged(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
                  .distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("m"))
        nearer = labels.join(around, "node").select("node", F.col("component").alias("old"), F.least("component", "m").alias("c"))
        jump = labels.select(F.col("node").alias("c"), F.col("component").alias("further"))
        new = staged(nearer.join(jump, "c").select("node", F.least("c", "further").alias("component"), "old"), "labels")
        labels = new.select("node", "component")
        if new.where("component <> old").limit(1).count() == 0:
            return labels
