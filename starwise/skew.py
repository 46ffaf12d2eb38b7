"""Key lookups that hold up when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwise.config import SkewConfig

ColumnOrName = Column | str


def key_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key as ``n``; partial counts are combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def hot_keys(counts: DataFrame, keys: Sequence[str], total: int, skew: SkewConfig) -> DataFrame | None:
    """Hot keys with their rows ``n`` and the number of ``pieces`` to cut each into, if there are any.

    ``counts`` has the key columns and their rows ``n``, ``total`` is the number of all rows. A hot
    key holds more than ``skew.share`` of them, so at most ``1 / skew.share`` keys come to the
    driver, and their pieces together number at most ``2 / skew.share``. Deciding this before the
    join keeps the common plan, without hot keys, free of any extra step.
    """
    piece = max(total * skew.share, skew.min_rows)
    if total <= piece:
        return None
    hot = counts.where(F.col("n") > piece).select(
        *keys, "n", F.ceil(F.col("n") / piece).cast("int").alias("pieces")
    )
    found = hot.collect()
    return counts.sparkSession.createDataFrame(found, hot.schema) if found else None


class HotPairs(NamedTuple):
    """Number of (user, item) rows, their hot items and their hot users."""

    total: int
    items: DataFrame | None
    users: DataFrame | None


def hot_pairs(pairs: DataFrame, skew: SkewConfig) -> HotPairs:
    """Hot keys of (user, item) rows that are cheap to read."""
    by_item = key_counts(pairs, "item")
    total = by_item.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    items = hot_keys(by_item, ["item"], total, skew)
    return HotPairs(total, items, hot_keys(key_counts(pairs, "user"), ["user"], total, skew))


def split_fact(fact: DataFrame, hot: DataFrame, keys: Sequence[str], spread: Sequence[ColumnOrName]) -> DataFrame:
    """``fact`` with ``salt``: the piece of its hot key a row belongs to, 0 for cold keys.

    The piece follows from a hash of the ``spread`` columns, so a retried task chooses alike.
    """
    pieces = F.col("pieces")
    piece = F.pmod(F.xxhash64(*spread), pieces).cast("int")
    marked = fact.join(F.broadcast(hot.select(*keys, "pieces")), list(keys), "left")
    return marked.withColumn("salt", F.when(pieces.isNull(), 0).otherwise(piece)).drop("pieces")


def repeat_dim(dim: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dim`` with ``salt``: the row of a hot key once per piece, all others once."""
    last = F.coalesce(F.col("pieces") - 1, F.lit(0))
    marked = dim.join(F.broadcast(hot.select(*keys, "pieces")), list(keys), "left")
    return marked.withColumn("salt", F.explode(F.sequence(F.lit(0), last))).drop("pieces")


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    keys: str | Sequence[str],
    hot: DataFrame | None,
    spread: Sequence[ColumnOrName],
    how: str = "left",
) -> DataFrame:
    """Join ``fact`` to ``dim`` (one row per key), cutting the ``hot`` keys of ``fact``.

    The rows of a hot key go to several shuffle keys and meet a copy of the dimension row at each.
    Without hot keys this is the plain join.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if hot is None:
        return fact.join(dim, keys, how)
    split = split_fact(fact, hot, keys, spread)
    return split.join(repeat_dim(dim, hot, keys), [*keys, "salt"], how).drop("salt")
