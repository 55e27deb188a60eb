"""Connected components of a table of links, by the smallest label with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """From (a, b) longs: (node, component) for every node of a link; component is the smallest node reached.

    Each round takes the smallest label of all neighbours and then the label of that label, so the
    rounds grow with the logarithm of the longest path. Labels are written after each round.
    """
    both = staged(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard"))
        next_ = labels.join(heard, "node").select("node", F.col("component").alias("old"), F.least("component", "heard").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        next_ = next_.join(jump, "component").select("node", "old", F.least("component", "further").alias("component"))
        next_ = staged(next_, "labels")
        if next_.where("old <> component").isEmpty():
            return next_.select("node", "component")
        labels = next_.select("node", "component")
