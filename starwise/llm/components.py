"""Connected components by contracting every node into its lowest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwise.runtime import materialize


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from its lower to its higher end; loops and ends that are null leave."""
    ends = edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    return ends.where("low < high").select(F.col("low").alias("a"), F.col("high").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``label``) for every end of the undirected edges (``a``, ``b``).

    Ids must be digests (or otherwise in random order): then each round leaves a fixed share of
    the nodes on average, and the number of rounds grows with the logarithm of the largest
    component. A round takes minima, which are combined before the shuffle, and joins on the two
    ends, so that a hub with a third of the edges is never gathered. Every round is written to
    the checkpoint folder. ``label`` is one node of the component; no edges give no rows.
    """
    edges = materialize(_ordered(edges.select("a", "b")))
    rounds = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        lowest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        lowest = materialize(lowest.select("node", F.least("node", "low").alias("low")))
        further = lowest.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        step = materialize(lowest.join(further, "low").select("node", F.col("lower").alias("label")))
        rounds.append(step)
        left = step.select(F.col("node").alias("a"), F.col("label").alias("new_a"))
        right = step.select(F.col("node").alias("b"), F.col("label").alias("new_b"))
        moved = edges.join(left, "a").join(right, "b")
        edges = materialize(_ordered(moved.select(F.col("new_a").alias("a"), F.col("new_b").alias("b"))))
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = rounds[0]
    for step in rounds[1:]:
        onward = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = labels.join(onward, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return labels
