"""Connected components of a link table, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node of it) for every end of a link.

    By contraction: each round a node goes over to the smallest of itself and
    its neighbours, and links between nodes that became one are dropped, so
    links are few after the first round. Nodes should be hashes: in random order the
    graph shrinks by a constant share a round. Lineage is cut every round; the
    driver learns only whether links are left.
    """
    left = checkpointed(edges.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).distinct())
    labels = None
    while True:
        both = left.unionByName(left.select(F.col("y").alias("x"), F.col("x").alias("y")))
        merged = checkpointed(both.groupBy("x").agg(F.min("y").alias("y"))
                              .select(F.col("x").alias("node"), F.least("x", "y").alias("target")))
        if labels is None:
            labels = merged.select("node", F.col("target").alias("component"))
        else:
            further = merged.select(F.col("node").alias("component"), F.col("target").alias("further"))
            labels = checkpointed(labels.join(further, "component", "left")
                                  .select("node", F.coalesce("further", "component").alias("component")))
        ends = [merged.select(F.col("node").alias(end), F.col("target").alias(f"new_{end}")) for end in ("x", "y")]
        moved = left.join(ends[0], "x").join(ends[1], "y").filter("new_x <> new_y")
        left = checkpointed(moved.select(F.least("new_x", "new_y").alias("x"), F.greatest("new_x", "new_y").alias("y")).distinct())
        if not left.head(1):
            return labels
