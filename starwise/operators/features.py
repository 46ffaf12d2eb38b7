"""The 22 model features of a (user, item) pair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwise.functions.scalars import finite, safe_log1p
from starwise.skew import lookup
from starwise.sources.profiles import ITEM_FEATURES, USER_FEATURES

# The order of the model's inputs.
FEATURES = (*ITEM_FEATURES, *USER_FEATURES)
# Counts enter the model as log(1 + n).
LOG_FEATURES = frozenset(["b_review_cnt", *USER_FEATURES[1:]])


def model_inputs(profiles: DataFrame, key: str) -> DataFrame:
    """Profiles of one side as model inputs, computed once per profile and not once per pair.

    Counts become logs, and whatever is not finite becomes 0. ``<key>_stars`` keeps the profile's
    mean rating as it was read; it is NULL for spoiled records.
    """
    names, stars = (ITEM_FEATURES, "b_avg_stars") if key == "item" else (USER_FEATURES, "u_avg_stars")
    inputs = [
        finite(safe_log1p(F.col(name)) if name in LOG_FEATURES else F.col(name)).alias(name)
        for name in names
    ]
    kept = F.when(F.col("record_ok"), F.col(stars)).alias(f"{key}_stars")
    return profiles.select(key, *inputs, kept)


def with_profiles(
    pairs: DataFrame,
    user_inputs: DataFrame,
    item_inputs: DataFrame,
    hot_users: DataFrame | None,
    hot_items: DataFrame | None,
) -> DataFrame:
    """``pairs`` with the model inputs of both sides; NULL where there is no profile.

    ``hot_users`` and ``hot_items`` are the hot keys of ``pairs``.
    """
    found = lookup(pairs, item_inputs, "item", hot_items, ["user"])
    return lookup(found, user_inputs, "user", hot_users, ["item"])


def feature_vectors(pairs_with_profiles: DataFrame, *kept: str) -> DataFrame:
    """The kept columns and the 22 model inputs, 0 for missing profiles."""
    filled = [F.coalesce(name, F.lit(0.0)).alias(name) for name in FEATURES]
    return pairs_with_profiles.select(*kept, *filled)
