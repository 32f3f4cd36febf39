"""Connected components as label propagation with pointer jumping, on Spark tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links (a, b); the label is the smallest node reachable.

    Each round takes the smallest label among a node's neighbours and then the label of that
    label, so a path of n links needs about log n rounds. Rounds end when no label changes; the
    tables of a round are written to the shared folder. Joins are plain joins on the node, which
    Spark splits when one node (a group's leader) holds many links.
    """
    ends = links.where("a <> b")
    arcs = materialize(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "arcs")
    labels = materialize(arcs.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = (arcs.join(labels.select(F.col("node").alias("b"), F.col("label").alias("seen")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen")))
        best = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        up = best.select(F.col("node").alias("up"), F.col("label").alias("top"))
        jumped = best.join(up, F.col("label") == F.col("up")).select("node", "old", F.least("label", "top").alias("label"))
        stepped = materialize(jumped, "labels")
        labels = stepped.select("node", "label")
        if stepped.where("label <> old").isEmpty():
            return labels
