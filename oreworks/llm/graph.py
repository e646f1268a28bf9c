"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.llm.storage import cut


def components(links: DataFrame) -> DataFrame:
    """For links (a, b): node and label, the smallest node reachable, for every node linked.

    Every round a node takes the smallest label around it, then its label's label; the number of
    rounds follows the logarithm of the longest path, not the number of nodes. A node with very many
    links is only summed up (its neighbours' labels have one minimum per task).
    """
    both = cut(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label"))
    while True:
        labels = cut(labels)
        around = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(around, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = cut(lower.join(jump, "label").select("node", "was", F.least("label", "further").alias("label")))
        changed = new.where("label <> was").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
