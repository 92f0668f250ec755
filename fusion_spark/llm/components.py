"""Connected components of a stored graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fusion_spark.llm.store import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge; ``edges`` has columns a and b.

    A label is the least node of the component. Every round takes the least label among the
    neighbours and then the label's own label, so the paths halve; it ends when nothing
    changes. An empty table gives an empty result.
    """
    both = stored(
        edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .union(edges.select("b", "a")).filter("node <> other").distinct()
    )
    labels = stored(
        both.groupBy("node").agg(F.min("other").alias("least"))
        .select("node", F.least("node", "least").alias("label"))
    )
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(
            F.min("label").alias("least"))
        step = labels.join(near, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "least").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("root"))
        after = stored(step.join(jump, "label", "left").select(
            "node", "before", F.least("label", F.coalesce("root", "label")).alias("label")))
        if after.filter("before <> label").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")
