"""Connected components of a graph of links, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.plans.tables import write_table


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``links`` (a, b).

    Every round a node takes the smallest component around it and then that
    component's own; rounds grow with the logarithm of a component's width.
    Labels are stored after each round, so a lost executor costs one round.  A
    link may be NULL on neither side; loops and repeats change nothing.
    """
    both = write_table(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = write_table(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "labels")
    while True:
        around = (both.join(labels.select(F.col("node").alias("b"), "component"), "b")
                  .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        moved = labels.join(around, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("top"))
        after = write_table(moved.join(up, "component").select("node", "old", F.least("component", "top").alias("component")), "labels")
        if after.where(F.col("old") != F.col("component")).isEmpty():
            return after.select("node", "component")
        labels = after.select("node", "component")
