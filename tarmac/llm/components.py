"""Connected components of links as a table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every end of the ``links`` (a, b): the least node that is
    linked with it directly or through others.

    Each round takes the least label next to a node and then the label of that label,
    so the number of rounds grows with the logarithm of a chain's length. Every round
    is cut off by a checkpoint; hot nodes are left to the adaptive skew join.
    """
    both = links.select("a", "b").union(links.select("b", "a")).checkpoint()
    labels = both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.min("a")).alias("label")
    )
    labels = labels.checkpoint()
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        heads = labels.select(F.col("node").alias("label"), F.col("label").alias("head"))
        after = (
            lower.join(heads, "label")
            .select("node", F.least("label", "head").alias("label"), "old")
            .checkpoint()
        )
        changed = after.filter(F.col("label") != F.col("old")).limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels
