"""Connected components of an edge table, by labels that fall to the least node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentscope.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b); label is the least node reachable.

    Each round takes the least label among neighbours, then the label of that label, so paths
    shorten by half. Labels are stored per round, which keeps plans short and survives lost
    executors.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both.where("a <> b").distinct(), "component-edges")
    labels = materialise(
        both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")),
        "component-labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy("a")
            .agg(F.min("label").alias("m"))
            .select(F.col("a").alias("node"), "m")
        )
        lower = labels.join(near, "node").select(
            "node", "label", F.least("label", "m").alias("l")
        )
        jump = labels.select(F.col("node").alias("l"), F.col("label").alias("further"))
        step = materialise(
            lower.join(jump, "l", "left").select(
                "node",
                F.least("l", F.coalesce("further", "l")).alias("label"),
                (F.least("l", F.coalesce("further", "l")) < F.col("label")).alias("fell"),
            ),
            "component-labels",
        )
        labels = step.select("node", "label")
        if step.where("fell").isEmpty():
            return labels
