"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node reachable) for every node in the links a, b.

    Every node takes the smallest label around it and then follows labels to their own label, until nothing
    changes.  Each round is joins and partly aggregated minima over the links; nothing is gathered anywhere.
    """
    # Stored before it is turned round: made twice, a table of links that depends on the order of rows could differ.
    one_way = saved(links.select("a", "b").where("a != b"))
    both = saved(one_way.union(one_way.select("b", "a")).distinct())
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        around = (
            both.join(labels, both.b == labels.node)
            .groupBy(F.col("a").alias("n"))
            .agg(F.min("label").alias("near"))
        )
        closer = labels.join(around, labels.node == around.n).select(
            "node", F.least("label", "near").alias("hop"), F.col("label").alias("old")
        )
        onward = labels.select(F.col("node").alias("hop"), F.col("label").alias("far"))
        moved = saved(closer.join(onward, "hop").select("node", F.least("hop", "far").alias("label"), "old"))
        labels = moved.select("node", "label")
        if moved.where("label != old").isEmpty():
            return labels
