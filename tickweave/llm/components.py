"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickweave.llm.common import settled, used_up


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for all nodes of ``edges`` (columns ``a, b``, longs).

    Every round takes the smallest label among the neighbours and then the label of that label, so chains shrink
    geometrically. Labels are written out each round: lineage stays short and a lost executor costs one round at most.
    """
    both = settled(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    table = settled(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("c")).withColumnRenamed("a", "node"), "labels")
    while True:
        labels = table.select("node", "c")
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("c").alias("m"))
        near = labels.join(around, labels["node"] == around["a"], "left").select("node", F.col("c").alias("old"), F.least("c", F.coalesce("m", "c")).alias("c"))
        of = labels.select(F.col("node").alias("via"), F.col("c").alias("jump"))
        moved = near.join(of, near["c"] == of["via"], "left").select("node", "old", F.least("c", F.coalesce("jump", "c")).alias("c"))
        moved = settled(moved, "labels")
        used_up(table)
        table = moved
        if not moved.filter("c != old").limit(1).count():
            used_up(both)
            out = moved.select("node", F.col("c").alias("component"))
            out._settled_at = moved._settled_at
            return out
