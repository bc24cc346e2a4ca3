"""Connected components by repeated contraction, all in joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundspark.operators.lineage import materialise


def _compressed(step: DataFrame) -> DataFrame:
    """Follow ``node -> root`` until every root is its own; log(depth) joins."""
    while True:
        up = step.select(F.col("node").alias("root"), F.col("root").alias("__up"))
        jumped = step.join(up, "root", "left").select(
            "node",
            F.coalesce("__up", "root").alias("root"),
            (F.col("__up") < F.col("root")).alias("__moved"),
        )
        jumped = materialise(jumped, "cc-jump")
        step = jumped.select("node", "root")
        if jumped.where("__moved").isEmpty():
            return step


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> ``(node, root)``: root is the smallest node reachable, for linked nodes.

    Every round sends each node to its smallest neighbour, follows these arrows to the end and
    contracts the graph; at least half the nodes of a component with links go each time. No
    links: an empty table.
    """
    edges = links.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    edges = materialise(edges.distinct(), "cc-edges")
    labels = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        step = both.groupBy("node").agg(F.min("other").alias("other"))
        step = step.select("node", F.least("node", "other").alias("root"))
        step = _compressed(materialise(step, "cc-step"))
        if labels is None:
            labels = step
        else:
            again = step.select(F.col("node").alias("root"), F.col("root").alias("__new"))
            labels = labels.join(again, "root", "left").select(
                "node", F.coalesce("__new", "root").alias("root")
            )
            labels = materialise(labels, "cc-labels")
        left = step.select(F.col("node").alias("a"), F.col("root").alias("__a"))
        right = step.select(F.col("node").alias("b"), F.col("root").alias("__b"))
        edges = edges.join(left, "a").join(right, "b").where("__a <> __b")
        edges = edges.select(F.least("__a", "__b").alias("a"), F.greatest("__a", "__b").alias("b"))
        edges = materialise(edges.distinct(), "cc-edges")
    return edges.toDF("node", "root") if labels is None else labels
