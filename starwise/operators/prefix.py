"""Where numbered blocks start: sums of the sizes before each, in levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FAN = 1024


def block_starts(sizes: DataFrame, blocks: int, index: str = "block", size: str = "size", fan: int = FAN) -> DataFrame:
    """(index, start): the sum of all sizes at lower indexes.

    ``sizes`` has one row per block with indexes 0 to ``blocks - 1``; missing ones count as empty.
    Runs of ``fan`` blocks are summed to one row of the level above, whose starts are found the same
    way; within a run a window adds up at most ``fan`` rows. So no task sees more than ``fan`` rows of
    a window whatever the number of blocks, and levels are joined by their number.
    """
    before = Window.orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    if blocks <= fan:
        return sizes.select(index, F.coalesce(F.sum(size).over(before), F.lit(0)).alias("start"))
    group = f"{index}_run"
    numbered = sizes.select(index, size, F.floor(F.col(index) / fan).cast("bigint").alias(group))
    sums = numbered.groupBy(group).agg(F.sum(size).alias(size))
    above = block_starts(sums, -(-blocks // fan), group, size, fan).withColumnRenamed("start", "above")
    within = Window.partitionBy(group).orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(size).over(within), F.lit(0))
    placed = numbered.select(index, group, inside.alias("inside")).join(above, group)
    return placed.select(index, (F.col("above") + F.col("inside")).alias("start"))
