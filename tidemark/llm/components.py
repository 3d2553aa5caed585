"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """`edges` (a, b) to (node, label): the smallest node of each component. Staged.

    Each round takes the smallest label among a node's neighbours and then the label of that label, so long chains
    shrink by halves.
    """
    both = staged(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = staged(labels.join(seen, "node").select("node", "label", F.least("label", "near").alias("next")), "lower")
        jump = lower.select(F.col("node").alias("next"), F.col("next").alias("beyond"))
        moved = staged(lower.join(jump, "next").select("node", F.col("beyond").alias("next"), (F.col("beyond") < F.col("label")).alias("changed")), "moved")
        labels = moved.select("node", F.col("next").alias("label"))
        if moved.where("changed").isEmpty():
            return labels
