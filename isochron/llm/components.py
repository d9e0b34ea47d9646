"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the undirected ``edges`` (``a, b``): the smallest node reachable.

    Each round every node takes the smallest label among its own and its neighbours', and then its label's label, which
    halves the distance to go. Labels are stored after each round; only the number of changes reaches the driver.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a != b").distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        found = lower.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("further", "label")).alias("label")
        )
        found = stored(found, "labels")
        if found.where("label != old").isEmpty():
            return labels.withColumnRenamed("label", "component")
        labels = found.select("node", "label")
