"""Connected components of a link table, by joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.store import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the smallest node reachable over links (a, b); nodes without links are absent.

    Each round gives every node the least label among its neighbours' labels and then that
    label's own label, so chains shorten by halves. Labels are written after each
    round; nothing is gathered but the number of changes. Null ends are ignored.
    """
    both = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    edges = scratch.save(both.union(both.select("b", "a")).distinct(), "edges")
    labels = scratch.save(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("seen"))
        better = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "seen").alias("new"))
        above = labels.select(F.col("node").alias("new"), F.col("label").alias("above"))
        after = better.join(above, "new", "left").select("node", "old", F.least("new", F.coalesce("above", "new")).alias("label"))
        after = scratch.save(after, "labels")
        changed = after.where("label <> old").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
