"""Connected components of a graph of links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from parcelcast.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links (a, b): the smallest node of its component.

    Each round takes the smallest label of the neighbours, then the label of that label; so the rounds grow with the
    logarithm of a chain. Labels are written once a round; the driver sees a single count.
    """
    both = store(links.select("a", "b").union(links.select("b", "a")), "edges")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("was"), F.least("label", "near").alias("low"))
        of = labels.select(F.col("node").alias("low_node"), F.col("label").alias("low_label"))
        jumped = low.join(of, low["low"] == of["low_node"], "left").select(
            "node", "was", F.least("low", F.coalesce("low_label", "low")).alias("label"))
        jumped = store(jumped, "labels")
        labels = jumped.select("node", "label")
        if not jumped.filter("label <> was").limit(1).count():
            return labels
