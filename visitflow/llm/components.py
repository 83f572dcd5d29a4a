"""Connected components by smallest label, with pointer jumping; every round is checkpointed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import shared_folder


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: for each node of ``edges`` (a, b) the smallest node it reaches.

    A round takes the smallest label among a node and its neighbours, then
    the label of that label, so the rounds grow with the logarithm of the
    longest path.  Hubs are pre-aggregated before the shuffle.  Rows stay in
    Spark; the driver sees one count per round.
    """
    shared_folder(edges.sparkSession)
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct().checkpoint()
    labels = both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node").checkpoint()
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy(both["a"].alias("n")).agg(F.min("label").alias("least"))
        nearer = labels.join(seen, F.col("node") == F.col("n")).select(
            "node", F.col("label").alias("old"), F.least("label", "least").alias("label")
        )
        target = nearer.select(F.col("node").alias("t"), F.col("label").alias("far"))
        moved = nearer.join(target, F.col("label") == F.col("t")).select("node", "old", F.least("label", "far").alias("label"))
        moved = moved.checkpoint()
        labels = moved.select("node", "label")
        if moved.where("old <> label").isEmpty():
            return labels
