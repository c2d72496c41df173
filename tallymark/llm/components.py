"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.session import reliable_copy


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with a link.

    ``links`` has columns a and b.  Labels spread along the links, and every
    round also jumps to the label of the label, so long chains need few rounds.
    Rounds are cut off by reliable copies.
    """
    both = reliable_copy(
        links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct()
    )
    labels = reliable_copy(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component"))
    )
    while True:
        seen = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        closer = labels.join(seen, "node").select(
            "node", F.least("component", "near").alias("component"), F.col("component").alias("old")
        )
        of_label = labels.select(F.col("node").alias("component"), F.col("component").alias("jump"))
        jumped = reliable_copy(
            closer.join(of_label, "component", "left").select(
                "node", F.least("component", F.coalesce("jump", "component")).alias("component"), "old"
            )
        )
        labels = jumped.select("node", "component")
        if jumped.where("component != old").isEmpty():
            return labels
