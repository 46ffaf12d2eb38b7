"""Neighbour lists: the most similar items of each item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starwise.config import Config


def similarity_edges(similarity: DataFrame) -> DataFrame:
    """Both directions of every pair, in one pass over the pairs."""
    both = F.array(
        F.struct(F.col("i").alias("item"), F.col("j").alias("nbr")),
        F.struct(F.col("j").alias("item"), F.col("i").alias("nbr")),
    )
    return similarity.select(F.explode(both).alias("e"), "sim").select("e.item", "e.nbr", "sim")


def top_neighbors(edges: DataFrame, config: Config) -> DataFrame:
    """The ``top_k`` neighbours per item by similarity, then id.

    Spark cuts each item to ``top_k`` rows per task before the shuffle, so an item with very many
    neighbours does not fill one task.
    """
    best = Window.partitionBy("item").orderBy(F.round("sim", 9).desc(), "nbr")
    return (
        edges.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= config.top_k)
        .select("item", "nbr", "sim", F.col("rank").cast("bigint").alias("rank"))
    )


def neighbor_count(neighbors: DataFrame) -> DataFrame:
    return neighbors.groupBy("item").agg(F.count("nbr").alias("neighbor_cnt"))


def packed_neighbors(neighbors: DataFrame) -> DataFrame:
    """One row per item with its list (at most ``top_k`` entries) and the list's length."""
    return neighbors.groupBy("item").agg(
        F.collect_list(F.struct("nbr", "sim")).alias("nbrs"), F.count("nbr").alias("neighbor_cnt")
    )
