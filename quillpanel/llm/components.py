"""Connected components of an edge list, distributed: labels spread along edges until none changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillpanel.session import durable


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node of each component. edges: columns a and b, in any direction.

    Each round every node takes the least label among its own and its neighbours', then the label of that label
    (pointer jumping), so the rounds grow with the logarithm of a component's length. Aggregates are partial, so a
    node of any degree fits; the lineage is cut by checkpoints. An empty edge list has no components."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter(F.col("a") != F.col("b")).distinct()
    both = durable(both)
    labels = durable(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(F.col("a").alias("node"), "label"))
    while True:
        spread = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(spread, labels["node"] == spread["a"], "left").select("node", "label", F.least("label", "near").alias("new"))
        root = labels.select(F.col("node").alias("r"), F.col("label").alias("r_label"))
        jumped = nearer.join(root, nearer["new"] == root["r"], "left").select("node", F.least("new", "r_label").alias("label"), (F.least("new", "r_label") != F.col("label")).alias("moved"))
        jumped = durable(jumped)
        moved = jumped.filter("moved").limit(1).count()
        labels = jumped.select("node", "label")
        if not moved:
            return labels.withColumnRenamed("label", "component")
