"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchwell.storage import materialize

JUMPS = 3


def components(edges: DataFrame) -> DataFrame:
    """(node, label: the smallest node of its component) for the nodes of ``edges`` (a, b).

    Every round hooks each node to its smallest neighbour, follows the hooks a few steps and
    contracts the edges, which at least halves the nodes that still have one.
    """
    left = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    both = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = materialize(both.select("node", F.col("node").alias("label")), "labels")
    while left.head(1):
        ends = left.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            left.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        hooks = materialize(ends.groupBy("node").agg(F.least("node", F.min("other")).alias("up")), "hooks")
        for _ in range(JUMPS):
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("next"))
            hooks = hooks.join(above, "up").select("node", F.col("next").alias("up"))
        hooks = materialize(hooks, "hooks")
        moved = hooks.select(F.col("node").alias("label"), "up")
        labels = labels.join(moved, "label", "left").select("node", F.coalesce("up", "label").alias("label"))
        labels = materialize(labels, "labels")
        for end in ("a", "b"):
            left = left.join(hooks.select(F.col("node").alias(end), "up"), end).drop(end).withColumnRenamed("up", end)
        left = left.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        left = materialize(left, "edges")
    return labels
