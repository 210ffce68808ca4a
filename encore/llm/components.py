"""Connected components of a table of links, by distributed label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.session import ensure_checkpoint_dir


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over the links (a, b); nodes without a link have no row.

    A round takes, for every node, the smallest label among its own and its
    neighbours', then the label of that label (pointer jumping), so labels
    travel distances that double. Each round is checkpointed; the end is when
    no label changes.
    """
    ensure_checkpoint_dir(links.sparkSession)
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("component")).checkpoint()
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m")))
        lower = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "m").alias("c"))
        jump = labels.select(F.col("node").alias("c"), F.col("component").alias("up"))
        new = lower.join(jump, "c", "left").select(
            "node", "old", F.least("c", F.coalesce("up", "c")).alias("component")).checkpoint()
        changed = new.where(F.col("component") != F.col("old")).limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
