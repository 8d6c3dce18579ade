"""Connected components of a large graph of links, without a driver-side structure."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) for every node of `links` (a, b); label is the least node reachable.

    A round takes the least label over a node's links, then the label of that label, so
    a chain shortens by more than half. Links keep their ends, and so their degrees; only
    the label look-up can be hot, and there the hot side is the one that Spark splits.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    for _ in range(rounds):
        seen = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = stored(
            labels.join(seen, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old")),
            "labels",
        )
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = lower.join(up, "label").select("node", F.least("label", "root").alias("label"), "old")
        labels = stored(jumped, "labels")
        if labels.filter("label <> old").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
    raise RuntimeError(f"links not settled after {rounds} rounds")
