"""Connected components of links between long ids, as rounds of joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.scratch import via_table


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every id in links (a, b); the component is its least id.

    A round takes the least label among a node's neighbours, and then the label of its label, so chains halve.
    Labels are written each round, which cuts the lineage. Nothing but counts comes to the driver.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = via_table(both.where(F.col("a") != F.col("b")).distinct(), "links")
    labels = both.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("node"), F.least("a", "low").alias("component")
    )
    labels = via_table(labels, "labels")
    while True:
        of_neighbour = labels.select(F.col("node").alias("b"), F.col("component").alias("offered"))
        offered = both.join(of_neighbour, "b").groupBy("a").agg(F.min("offered").alias("offered"))
        lower = labels.join(offered, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("was"), F.least("component", "offered").alias("component")
        )
        lower = via_table(lower, "labels")
        of_label = lower.select(F.col("node").alias("label"), F.col("component").alias("next"))
        labels = via_table(
            lower.join(of_label, F.col("component") == F.col("label"), "left").select(
                "node", "was", F.least("component", F.coalesce("next", "component")).alias("component")
            ),
            "labels",
        )
        if labels.where(F.col("was") != F.col("component")).isEmpty():
            return labels.select("node", "component")
