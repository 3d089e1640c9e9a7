"""Connected components of a graph given as a table of links; nothing of it goes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veristrata.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b", smaller=None) -> DataFrame:
    """(node, component): for each node of a link the smallest node that it is linked with, over any steps.

    Each round every node takes the smallest label among its neighbours' and its own, then follows the
    label's own label; rounds go on until no label changes. Labels are minima, combined in each task before
    they are shuffled, so a node with very many links sends one row per task.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).union(
        links.select(F.col(b), F.col(a))
    )
    edges = stored(both.distinct(), "links")
    labels = stored(
        edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), "labels"
    )
    while True:
        seen = edges.join(labels.select(F.col("node").alias("other"), "label"), "other")
        lowest = seen.groupBy("node").agg(F.min("label").alias("around"))
        nearer = labels.join(lowest, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "around").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        following = nearer.join(jump, "label").select(
            "node", "old", F.least("label", "far").alias("label")
        )
        labels = stored(following, "labels")
        if labels.where(F.col("label") != F.col("old")).isEmpty():
            return labels.select("node", F.col("label").alias("component"))
        labels = labels.select("node", "label")
