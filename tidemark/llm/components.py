"""Connected components of an edge table, by rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) for every
    node of an edge.

    Each round a node takes the smallest label around it and then the label of
    that label, which halves the way to the smallest node.  Labels are written
    to the shared checkpoint folder after each round; only the number of
    changed rows comes back to the driver.
    """
    both = materialise(edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
                       .unionByName(edges.select(F.col(b).alias("x"), F.col(a).alias("y")))
                       .filter("x <> y").distinct(), "cc-edges")
    labels = materialise(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m"))
                         .select("node", F.least("node", "m").alias("label")), "cc-labels")
    while True:
        around = (both.join(labels.withColumnRenamed("node", "x"), "x")
                  .groupBy(F.col("y").alias("node")).agg(F.min("label").alias("m")))
        nearer = (labels.withColumnRenamed("label", "old").join(around, "node")
                  .select("node", "old", F.least("old", "m").alias("label")))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = materialise(nearer.join(jump, "label")
                          .select("node", F.least("label", "further").alias("label"),
                                  (F.least("label", "further") != F.col("old")).alias("changed")), "cc-labels")
        labels = new.select("node", "label")
        if new.filter("changed").limit(1).count() == 0:
            return labels
