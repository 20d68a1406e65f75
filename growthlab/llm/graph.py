"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthlab.llm.storage import forget, stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node with an edge; label is the smallest node of its component.

    Smallest labels travel along edges and then jump to their own label, so rounds grow with the
    logarithm of the longest chain. Each round is a written table: lineage stays short and a lost
    executor repeats one round at most. Sums per node are combined before the shuffle."""
    pairs = stored(
        edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y").distinct(), "edges"
    )
    both = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
    labels = stored(
        both.groupBy(F.col("x").alias("node")).agg(F.least(F.col("x"), F.min("y")).alias("label")), "labels"
    )
    while True:
        heard = (
            both.join(labels.select(F.col("node").alias("y"), F.col("label").alias("heard")), "y")
            .groupBy(F.col("x").alias("node"))
            .agg(F.min("heard").alias("heard"))
        )
        lower = labels.join(heard, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "heard").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = stored(
            lower.join(jump, "label", "left").select(
                "node", "was", F.least("label", F.coalesce("next", "label")).alias("label")
            ),
            "labels",
        )
        forget(labels)
        labels = after.select("node", "label")
        if after.where("was <> label").isEmpty():
            forget(pairs)
            return labels
