"""Connected components of a graph of pairs, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def components(pairs: DataFrame) -> DataFrame:
    """One row (node, root) per node of the pairs (a, b); the root is the smallest node that can be reached.

    Each round every node that is left points to its smallest neighbour, or stays if it is the smallest itself; pointers are
    followed to their ends, the edges move to these ends, and those within one end go. At least half of the nodes that still
    have an edge end with each round. Only aggregates that combine before the shuffle, and joins with one row per node on one
    side, so a node with very many neighbours is split like any hot key.
    """
    edges = stored(pairs.filter("a <> b").select("a", "b").distinct(), "edges")
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("root"))
        step = _followed(stored(step, "step"))
        if labels is None:
            labels = step
        else:
            moved = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = labels.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        for side in ("a", "b"):
            ends = step.select(F.col("node").alias(side), F.col("root").alias("end"))
            edges = edges.join(ends, side).drop(side).withColumnRenamed("end", side)
        edges = stored(edges.filter("a <> b").select("a", "b").distinct(), "edges")
        if edges.isEmpty():
            return stored(labels, "labels")
        labels = stored(labels, "labels")


def _followed(step: DataFrame) -> DataFrame:
    """Pointers to their ends; chains halve with each pass."""
    while True:
        ahead = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = stored(step.join(ahead, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "step")
        if jumped.filter("moved").isEmpty():
            return jumped.select("node", "root")
        step = jumped.select("node", "root")
