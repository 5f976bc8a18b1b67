"""Connected components of written links, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the smallest node that can be reached.

    Each round takes the smallest label among the neighbours, then the label of that label, so chains shrink
    by halves.  Tables are written each round; a node with very many links is one row per task before it is moved,
    and the joins are of plain scans, which can be split.
    """
    both = cut(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(),
        "links",
    )
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy(F.col("a").alias("n"))
            .agg(F.min("label").alias("near"))
        )
        step = cut(
            labels.join(near, F.col("node") == F.col("n")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")),
            "labels",
        )
        jump = step.select(F.col("node").alias("via"), F.col("label").alias("far"))
        after = cut(
            step.join(jump, F.col("label") == F.col("via")).select("node", "old", F.least("label", "far").alias("label")), "labels"
        )
        moved = after.where("label <> old").limit(1).count()
        labels = after.select("node", "label")
        if not moved:
            return labels.select("node", F.col("label").alias("component"))
