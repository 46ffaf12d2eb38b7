"""Rating statistics, activity and popularity filters, the mean-rating baseline."""

from __future__ import annotations

import math
from functools import cached_property

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from starwise.config import Config
from starwise.operators.prefix import FAN, block_starts
from starwise.runtime import written
from starwise.skew import hot_keys, key_counts, lookup


def dedupe_ratings(ratings: DataFrame) -> DataFrame:
    """One rating per (user, item): the highest, so the outcome does not depend on row order."""
    return ratings.groupBy("user", "item").agg(F.max("stars").alias("stars"))


def item_stats(ratings: DataFrame, *more: Column) -> DataFrame:
    return ratings.groupBy("item").agg(F.avg("stars").alias("avg_stars"), F.count("stars").alias("n"), *more)


def user_stats(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user").agg(F.avg("stars").alias("avg_stars"), F.count("stars").alias("n"))


def global_stats(ratings: DataFrame) -> DataFrame:
    return ratings.agg(F.avg("stars").alias("avg_stars"), F.count("stars").alias("n"))


class RatingFacts:
    """Ratings with the statistics that many operators need, each computed once on first use.

    ``ratings`` is read several times, so it should come from files or a checkpoint. The
    statistics have one row per item or user and are written to the checkpoint folder; only the
    global mean and the bounded lists of hot keys reach the driver.
    """

    def __init__(self, ratings: DataFrame, config: Config):
        self.ratings = ratings
        self.config = config

    @cached_property
    def by_item(self) -> DataFrame:
        return written(item_stats(self.ratings, F.sum("stars").alias("sum_stars")))

    @cached_property
    def by_user(self) -> DataFrame:
        return written(user_stats(self.ratings))

    @cached_property
    def hot_items(self) -> DataFrame | None:
        return hot_keys(self.by_item, ["item"], self._totals["n"], self.config.skew)

    @cached_property
    def hot_users(self) -> DataFrame | None:
        return hot_keys(self.by_user, ["user"], self._totals["n"], self.config.skew)

    @cached_property
    def _totals(self) -> Row:
        """Read off the items' sums, not the ratings again."""
        total = F.sum("n")
        return self.by_item.agg((F.sum("sum_stars") / total).alias("avg_stars"), F.coalesce(total, F.lit(0)).alias("n")).first()

    @property
    def n_ratings(self) -> int:
        return self._totals["n"]

    @property
    def mean_value(self) -> float:
        return self._totals["avg_stars"]

    @property
    def mean(self) -> Column:
        return F.lit(self.mean_value).cast("double")

    @property
    def has_integer_users(self) -> bool:
        return isinstance(self.ratings.schema["user"].dataType, T.IntegralType)


def user_history(ratings: DataFrame) -> DataFrame:
    """Size, sum and extent of every user's history.

    The history itself stays as rows: as an array it would put a whole user into one task.
    """
    return ratings.groupBy("user").agg(
        F.count("item").alias("n"),
        F.sum("stars").alias("sum_stars"),
        F.min("item").alias("min_item"),
        F.max("item").alias("max_item"),
    )


def active_users(by_user: DataFrame, config: Config) -> DataFrame:
    """Users whose number of ratings lies within the co-rater bounds."""
    bounds = F.col("n").between(config.min_user_ratings, config.max_user_ratings)
    return by_user.where(bounds).select("user", "n")


def without_heavy_users(facts: RatingFacts) -> DataFrame:
    """Ratings without hot users that are beyond the co-rater bound anyway.

    The broadcast drops them before any shuffle, so that no single user fills a partition only to
    be thrown away there.
    """
    if facts.hot_users is None:
        return facts.ratings
    heavy = facts.hot_users.where(F.col("n") > facts.config.max_user_ratings).select("user")
    return facts.ratings.join(F.broadcast(heavy), "user", "left_anti")


def active_ratings(facts: RatingFacts) -> DataFrame:
    """Ratings of active users."""
    active = active_users(facts.by_user, facts.config).select("user")
    return without_heavy_users(facts).join(active, "user")


def popular_items(by_item: DataFrame, config: Config) -> DataFrame:
    return by_item.where(F.col("n") >= config.lsh.min_item_ratings).select("item", "n")


def popular_ratings(facts: RatingFacts) -> DataFrame:
    """Ratings of popular items."""
    popular = popular_items(facts.by_item, facts.config).select("item")
    return lookup(facts.ratings, popular, "item", facts.hot_items, ["user"], how="inner")


def item_raters(ratings: DataFrame) -> DataFrame:
    """Number of different users per item; duplicates fall away before the shuffle."""
    return (
        ratings.select("item", "user").distinct().groupBy("item").agg(F.count("user").alias("n_users"))
    )


USERS_PER_BUCKET = 50_000


def user_index(ratings: DataFrame, buckets: int | None = None, fan: int = FAN) -> DataFrame:
    """Dense numbers 0, 1, 2 ... for the different users.

    Users are numbered within hash buckets in parallel, and each bucket starts where the buckets
    before it end (``block_starts``, in levels of ``fan``). Unless their number is given, there are
    4,096 buckets, or so many more (by powers of 16) that a bucket has about 50,000 users at most.
    Buckets grow with the users, so their starts are joined and never broadcast by hint.
    """
    distinct = ratings.select("user").distinct()
    if buckets is None:
        digits = max(3, math.ceil(math.log(max(1, distinct.count()) / USERS_PER_BUCKET, 16)))
    else:
        digits = len(f"{buckets - 1:x}")
        if 16**digits != buckets:
            raise ValueError("buckets must be a power of 16")
    bucket = F.conv(F.substring(F.md5(F.col("user").cast("string")), 1, digits), 16, 10).cast("bigint")
    users = distinct.withColumn("bucket", bucket)
    sizes = users.groupBy("bucket").agg(F.count("user").alias("size"))
    starts = block_starts(sizes, 16**digits, "bucket", "size", fan)
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("user"))
    return (
        users.withColumn("rank", rank)
        .join(starts, "bucket")
        .select("user", (F.col("start") + F.col("rank") - 1).cast("bigint").alias("ix"))
    )


def baseline_predict(requests: DataFrame, facts: RatingFacts) -> DataFrame:
    """Item mean for every request, global mean for unknown items."""
    means = facts.by_item.select("item", "avg_stars")
    hot = hot_keys(key_counts(requests, "item"), ["item"], requests.count(), facts.config.skew)
    found = lookup(requests, means, "item", hot, ["user"])
    return found.select(
        "user",
        "item",
        F.coalesce("avg_stars", facts.mean).alias("prediction"),
        F.when(F.col("avg_stars").isNull(), "global_mean").otherwise("item_mean").alias("reason"),
    )
