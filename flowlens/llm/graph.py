"""Connected components by minimum labels with pointer jumping, on Spark tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.workspace import by_shuffle, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the least node id of its component.

    Every round takes the least label among the neighbours (a partial aggregation,
    so a hub is no hot key), then follows its label once more, which doubles the
    reach.  Rounds are written tables, joined by shuffles; only a sign of change reaches the driver.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                    .select("node", F.least("node", "b").alias("root")), "labels")
    while True:
        near = (both.join(by_shuffle(labels), both["b"] == labels["node"]).groupBy(F.col("a").alias("node"))
                .agg(F.min("root").alias("near")))
        step = labels.join(by_shuffle(near), "node", "left").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        far = step.select(F.col("node").alias("root"), F.col("root").alias("far"))
        moved = stored(step.join(by_shuffle(far), "root", "left").select("node", "old", F.least("root", "far").alias("root")), "labels")
        labels = moved.select("node", "root")
        if not moved.where("old != root").head(1):
            return labels
