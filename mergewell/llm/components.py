"""Connected components by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergewell.llm.common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` → ``node, label``: the smallest node reachable, itself included.

    Each round every node takes the smallest label among its neighbours, then
    the label of its label; labels only fall, and a round without a change ends
    it. Everything stays distributed; a hub's edges meet in a minimum, which
    is taken before the shuffle. No edges, no nodes.
    """
    both = checkpointed(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels, both["a"] == labels["node"]).groupBy(F.col("b").alias("node")).agg(F.min("label").alias("_near"))
        hooked = labels.join(near, "node").select("node", F.col("label").alias("_was"), F.least("label", "_near").alias("_hook"))
        jump = labels.select(F.col("node").alias("_hook"), F.col("label").alias("_jump"))
        done = hooked.join(jump, "_hook", "left").select("node", "_was", F.least("_hook", "_jump").alias("label"))
        done = checkpointed(done)
        labels = done.select("node", "label")
        if done.where("label <> _was").isEmpty():
            return labels
