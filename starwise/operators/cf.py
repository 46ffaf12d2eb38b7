"""Item-based collaborative filtering for (user, item) requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwise.config import Config
from starwise.functions.scalars import clip
from starwise.operators.neighbors import packed_neighbors
from starwise.operators.stats import RatingFacts
from starwise.runtime import materialize
from starwise.sketch import key_sketch, might_match
from starwise.skew import HotPairs, hot_keys, hot_pairs, key_counts, lookup

# Above this share of all users a sketch of those who ask drops too few ratings to be worth reading.
ASKING_SHARE = 0.5


def open_requests(unique: DataFrame, packed: DataFrame, hot_items: DataFrame | None) -> DataFrame:
    """(user, item, nbr, sim): every neighbour of the requested item.

    The join moves one packed list per item; a request grows to at most ``top_k`` rows after it.
    """
    found = lookup(unique, packed.select("item", "nbrs"), "item", hot_items, ["user"], how="inner")
    return found.select("user", "item", F.explode("nbrs").alias("e")).select("user", "item", "e.nbr", "e.sim")


def hot_neighbors(opened: DataFrame, hot: HotPairs, config: Config) -> DataFrame | None:
    """Hot (user, nbr) keys of opened requests.

    A request has at most ``top_k`` neighbours, and only a hot user can make such a key hot, so
    the keys are counted among the rows of hot users alone.
    """
    if hot.users is None:
        return None
    of_hot_users = opened.join(F.broadcast(hot.users.select("user")), "user")
    counts = key_counts(of_hot_users, "user", "nbr")
    return hot_keys(counts, ["user", "nbr"], hot.total * config.top_k, config.skew)


def asked_ratings(unique: DataFrame, facts: RatingFacts) -> DataFrame:
    """The ratings of users who ask, and few others; all ratings if most users do.

    With fewer requests fewer ratings go into the shuffle by (user, neighbour). The result of the
    join there is the same in both cases.
    """
    asking = unique.select("user").distinct()
    if asking.count() > ASKING_SHARE * facts.by_user.count():
        return facts.ratings
    return might_match(facts.ratings, "user", key_sketch(asking, "user"))


def rated_neighbors(unique: DataFrame, packed: DataFrame, hot: HotPairs, facts: RatingFacts) -> DataFrame:
    """Neighbours the user has rated, summed per request.

    The join is on (user, neighbour), at which a rating is unique, so long histories are never
    gathered. Neighbours with similarity 0 count as common but carry no weight.
    """
    opened = open_requests(unique, packed, hot.items)
    stars = asked_ratings(unique, facts).select("user", F.col("item").alias("nbr"), "stars")
    hot_nbrs = hot_neighbors(opened, hot, facts.config)
    return (
        lookup(opened, stars, ["user", "nbr"], hot_nbrs, ["item"], how="inner")
        .groupBy("user", "item")
        .agg(
            F.count(F.lit(1)).alias("n_common"),
            F.sum(F.col("stars") * F.col("sim")).alias("weighted"),
            F.sum(F.abs("sim")).alias("weight"),
        )
    )


def common_neighbors(requests: DataFrame, facts: RatingFacts, neighbors: DataFrame) -> DataFrame:
    """(user, item, n_common) for requests with at least one rated neighbour."""
    unique = materialize(requests.select("user", "item").distinct())
    hot = hot_pairs(unique, facts.config.skew)
    found = rated_neighbors(unique, materialize(packed_neighbors(neighbors)), hot, facts)
    return found.select("user", "item", "n_common")


def cf_reason() -> Column:
    """Which exit a request takes, from user_avg, neighbor_cnt, n_common and weight."""
    return (
        F.when(F.col("user_avg").isNull(), "new_user")
        .when(F.coalesce("neighbor_cnt", F.lit(0)) == 0, "no_neighbors")
        .when(F.col("n_common").isNull(), "no_common")
        .when(F.col("weight") == 0, "zero_weight")
        .otherwise("weighted")
    )


def cf_score(global_mean: Column, config: Config) -> Column:
    """Weighted mean of the user's ratings of neighbours, smoothed and clipped.

    All other exits return the item mean, or the global mean of an unknown item, as it is.
    """
    fallback = F.coalesce("item_avg", global_mean)
    mean = F.try_divide("weighted", "weight")
    mean = F.when(F.isnan(mean) | (F.abs(mean) == float("inf")), fallback).otherwise(mean)
    k = F.least(
        config.cf_smooth_base + F.col("n_common") / config.cf_smooth_per, F.lit(config.cf_smooth_max)
    )
    smoothed = clip((1 - k) * mean + k * global_mean, config.min_stars, config.max_stars)
    return F.when(cf_reason() == "weighted", smoothed).otherwise(fallback)
