"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(node, comp)`` for every node of ``edges(a, b)``: comp is the smallest
    node that can be reached.

    Each round a node takes the smallest label among its neighbours and then
    the label of that label, so long chains halve; labels are written after
    every round and the rounds end when none changes.  Minima are aggregated
    before the shuffle, so a hub costs one row per task."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = both.select(F.col("a").alias("node")).distinct().withColumn("comp", F.col("node"))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("near"))
        nearer = labels.join(near, labels["node"] == near["a"]).select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        target = nearer.select(F.col("node").alias("__to"), F.col("comp").alias("__next"))
        jumped = nearer.join(target, nearer["comp"] == target["__to"]).select("node", "old", F.least("comp", "__next").alias("comp"))
        written = materialize(jumped, "labels")
        labels = written.select("node", "comp")
        if written.where(F.col("old") != F.col("comp")).isEmpty():
            return labels
