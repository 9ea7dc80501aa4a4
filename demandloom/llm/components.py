"""Connected components of links between long keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest key that each end of links(a, b) can reach.

    Every round a node takes the smallest label among its own and its neighbours', then the label
    of that label; rounds grow with the logarithm of the longest path.  Labels are written each
    round, so a lost executor costs one round at most.
    """
    both = written(
        links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct(), "links"
    )
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select(
            "node", F.least("node", "label").alias("label")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("to"), "label")
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("further"))
        moved = written(
            lower.join(jump, "to", "left").select(
                "node", F.least("to", F.coalesce("further", "to")).alias("new"), F.col("label").alias("old")
            ),
            "labels",
        )
        labels = moved.select("node", F.col("new").alias("label"))
        if moved.where("new != old").isEmpty():
            return labels
