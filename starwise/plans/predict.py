"""From ratings to neighbour lists, and from requests to predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwise.config import Config
from starwise.functions.scalars import pair_hash
from starwise.operators import cf, features, hybrid, lsh, model, neighbors, similarity, tuning
from starwise.operators.stats import RatingFacts
from starwise.runtime import written
from starwise.skew import HotPairs, hot_keys, hot_pairs, key_counts, lookup


def find_buckets(facts: RatingFacts) -> DataFrame:
    """Buckets of the items that have company; the signatures behind them are written once."""
    return lsh.shared_buckets(written(lsh.band_signatures(facts)), facts.config)


def find_moments(facts: RatingFacts, buckets: DataFrame | None = None) -> DataFrame:
    return similarity.pair_moments(facts, find_buckets(facts) if buckets is None else buckets)


def find_neighbors(facts: RatingFacts, buckets: DataFrame | None = None) -> DataFrame:
    """(item, nbr, sim, rank): the neighbour list of every item that has one."""
    similar = similarity.pair_similarity(find_moments(facts, buckets), facts.config)
    return neighbors.top_neighbors(neighbors.similarity_edges(similar), facts.config)


def request_cards(
    unique: DataFrame,
    facts: RatingFacts,
    packed: DataFrame | None = None,
    item_inputs: DataFrame | None = None,
    user_inputs: DataFrame | None = None,
    hot: HotPairs | None = None,
) -> DataFrame:
    """``unique`` requests with item_avg, user_avg and whatever is given: neighbor_cnt, profiles.

    All facts about an item are put on one card first, and all about a user on another, so that a
    request is joined to two cards instead of to every table.
    """
    item_card = facts.by_item.select("item", F.col("avg_stars").alias("item_avg"))
    user_card = facts.by_user.select("user", F.col("avg_stars").alias("user_avg"))
    if packed is not None:
        item_card = item_card.join(packed.select("item", "neighbor_cnt"), "item", "left")
    if item_inputs is not None:
        item_card = item_card.join(item_inputs, "item", "full")
    if user_inputs is not None:
        user_card = user_card.join(user_inputs, "user", "full")
    hot = hot or hot_pairs(unique, facts.config.skew)
    with_items = lookup(unique, item_card, "item", hot.items, ["user"])
    return lookup(with_items, user_card, "user", hot.users, ["item"])


def request_frame(
    requests: DataFrame,
    facts: RatingFacts,
    neighbor_lists: DataFrame,
    item_inputs: DataFrame | None = None,
    user_inputs: DataFrame | None = None,
    cf_gate: int = 1,
) -> DataFrame:
    """One row per different request: its cards and its rated neighbours.

    Neighbours are only looked up for items with ``cf_gate`` of them or more; the columns
    n_common, weighted and weight are NULL elsewhere.
    """
    unique = written(requests.select("user", "item").distinct())
    hot = hot_pairs(unique, facts.config.skew)
    packed = written(neighbors.packed_neighbors(neighbor_lists))
    gated = packed.where(F.col("neighbor_cnt") >= cf_gate)
    hits = cf.rated_neighbors(unique, gated, hot, facts)
    cards = request_cards(unique, facts, packed, item_inputs, user_inputs, hot)
    return cards.join(hits, ["user", "item"], "left")


def cf_predict(requests: DataFrame, facts: RatingFacts, neighbor_lists: DataFrame) -> DataFrame:
    """(user, item, n_common, prediction, reason), one row per different request."""
    n_common = F.when(F.col("user_avg").isNotNull(), F.col("n_common"))
    return request_frame(requests, facts, neighbor_lists).select(
        "user",
        "item",
        F.coalesce(n_common, F.lit(0)).cast("bigint").alias("n_common"),
        cf.cf_score(facts.mean, facts.config).alias("prediction"),
        cf.cf_reason().alias("reason"),
    )


def blend(scored: DataFrame, facts: RatingFacts) -> DataFrame:
    """(user, item, neighbor_cnt, prediction) from a request frame with ``model_score``."""
    collaborative = cf.cf_score(facts.mean, facts.config)
    blended = hybrid.hybrid_score(F.col("model_score"), collaborative, facts.mean, facts.config)
    return scored.select(
        "user",
        "item",
        F.coalesce("neighbor_cnt", F.lit(0)).cast("bigint").alias("neighbor_cnt"),
        blended.alias("prediction"),
    )


def answer_all(requests: DataFrame, predictions: DataFrame, config: Config, otherwise: float) -> DataFrame:
    """One prediction per request row, from one prediction per different request.

    Every row is answered: a request with a null id gets ``otherwise``. Further columns of the
    requests stay. Copies of one request have nothing to tell them apart but their position, so a hot request is
    split by row number; ``requests`` must come from files or a checkpoint, where a retried task
    numbers its rows as before.
    """
    keys = ["user", "item"]
    hot = hot_keys(key_counts(requests, *keys), keys, requests.count(), config.skew)
    position = F.monotonically_increasing_id()
    known = predictions.where(F.col("user").isNotNull() & F.col("item").isNotNull())
    answered = lookup(requests, known, keys, hot, [position])
    return answered.withColumn("prediction", F.coalesce("prediction", F.lit(otherwise)))


def hybrid_predict(
    requests: DataFrame,
    facts: RatingFacts,
    neighbor_lists: DataFrame,
    user_inputs: DataFrame,
    item_inputs: DataFrame,
    fitted: model.RatingModel | None = None,
) -> DataFrame:
    """Blend of CF and the model, one row per different request.

    Without a fitted model its place is taken by the fallback score.
    """
    gate = facts.config.gate_neighbors
    frame = request_frame(requests, facts, neighbor_lists, item_inputs, user_inputs, gate)
    if fitted is None:
        scored = frame.withColumn("model_score", hybrid.fallback_score(facts.mean, facts.config))
    else:
        scored = model_scores(frame, fitted, facts)
    return blend(scored, facts)


def training_ratings(facts: RatingFacts) -> DataFrame:
    """The ratings to learn from: all, unless the caller asks for ``max_training_rows`` of them by their hash."""
    most = facts.config.model.max_training_rows
    if most is None or facts.n_ratings <= most:
        return facts.ratings
    bound = int(tuning.HASH_SPACE * (most / facts.n_ratings))
    return facts.ratings.where(pair_hash(F.col("user"), F.col("item")) < bound)


def n_training_ratings(facts: RatingFacts) -> int:
    """How many ratings ``training_ratings`` gives, or about as many."""
    most = facts.config.model.max_training_rows
    return facts.n_ratings if most is None else min(facts.n_ratings, most)


def training_features(facts: RatingFacts, user_inputs: DataFrame, item_inputs: DataFrame) -> DataFrame:
    """user, item, stars and the 22 model inputs for the ratings to learn from."""
    profiled = features.with_profiles(
        training_ratings(facts), user_inputs, item_inputs, facts.hot_users, facts.hot_items
    )
    return features.feature_vectors(profiled, "user", "item", "stars")


def tuning_features(
    facts: RatingFacts, user_inputs: DataFrame, item_inputs: DataFrame, size: int = 80_000
) -> DataFrame:
    """The training features of a sample of ratings.

    The sample is drawn first. It has at most ``size`` rows, so its keys can be broadcast to pick
    the few profiles it needs.
    """
    sample = written(tuning.tuning_sample(facts.ratings, size, facts.n_ratings))

    def needed(inputs: DataFrame, key: str) -> DataFrame:
        return inputs.join(F.broadcast(sample.select(key).distinct()), key, "left_semi")

    profiled = features.with_profiles(
        sample, needed(user_inputs, "user"), needed(item_inputs, "item"), None, None
    )
    return features.feature_vectors(profiled, "user", "item", "stars")


def model_scores(frame: DataFrame, fitted: model.RatingModel, facts: RatingFacts) -> DataFrame:
    """``frame`` with ``model_score``: the fitted model's score, smoothed and clipped."""
    kept = [c for c in frame.columns if c not in features.FEATURES]
    fallback = hybrid.fallback_score(facts.mean, facts.config).alias("fallback")
    inputs = features.feature_vectors(frame.select("*", fallback), *kept, "fallback")
    score = hybrid.model_postprocess(F.col("model_raw"), F.col("fallback"), facts.mean, facts.config)
    return fitted.score(inputs).withColumn("model_score", score)


def end_to_end(
    requests: DataFrame,
    ratings: DataFrame,
    user_features: DataFrame,
    item_features: DataFrame,
    config: Config,
    inputs: Sequence[str] = features.FEATURES,
) -> DataFrame:
    """(user, item, prediction) for every request row, from ratings and profiles.

    ``ratings`` and ``requests`` are read several times and must come from files or a checkpoint.
    The model looks at ``inputs``, all 22 unless fewer are named.
    """
    facts = RatingFacts(ratings, config)
    user_inputs = written(features.model_inputs(user_features, "user"))
    item_inputs = written(features.model_inputs(item_features, "item"))
    neighbor_lists = written(find_neighbors(facts))
    train = training_features(facts, user_inputs, item_inputs)
    fitted = model.fit(train, config.model, facts.mean_value, inputs, n_training_ratings(facts))
    predictions = hybrid_predict(requests, facts, neighbor_lists, user_inputs, item_inputs, fitted)
    answers = predictions.select("user", "item", "prediction")
    return answer_all(requests, answers, config, facts.mean_value)
