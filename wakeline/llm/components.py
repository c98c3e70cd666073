"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.sources.staging import staged


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable node for every node of ``links`` (a, b): node, component.

    Each round takes the least label among a node and its neighbours, then the label of
    that label, so that long chains shorten by half; rounds are written tables.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).filter("a != b")
    edges = staged(both.distinct(), "edges")
    labels = staged(
        edges.groupBy("a").agg(F.min("b").alias("near")).select(
            F.col("a").alias("node"), F.least("a", "near").alias("component")
        ),
        "labels",
    )
    while True:
        near = (
            edges.join(labels, edges.b == labels.node)
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        closer = labels.join(near, labels.node == near.a).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("now")
        )
        up = labels.select(F.col("node").alias("up"), F.col("component").alias("above"))
        moved = staged(
            closer.join(up, closer.now == up.up).select(
                "node", "old", F.least("now", "above").alias("component")
            ),
            "labels",
        )
        labels = moved.select("node", "component")
        if moved.filter("old != component").isEmpty():
            return labels
