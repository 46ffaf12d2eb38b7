"""The registered queries: one callable (spark, sf_dir) -> DataFrame per operator."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from catalog import tables
from starwise.config import HASH_PRIME, Config, LshConfig, ModelConfig, SkewConfig
from starwise.functions import scalars
from starwise.operators import (
    cf,
    evaluate,
    features,
    hybrid,
    lsh,
    model,
    neighbors,
    similarity,
    stats,
    tuning,
)
from starwise.plans import predict
from starwise.runtime import scratch_folder, written
from starwise.skew import hot_pairs
from starwise.sources import profiles
from starwise.sources import ratings as csv

Query = Callable[[SparkSession, str], DataFrame]

DEFAULT = Config()  # 20 bands x 5 rows
MIXED = Config(lsh=LshConfig(bands=33, rows=3))  # fires both sides of the neighbour gate
CASUAL = replace(Config(lsh=LshConfig(bands=33, rows=3)), max_user_ratings=14)  # few users are active
DENSE = Config(lsh=LshConfig(bands=50, rows=2))  # fills neighbour lists to the top
BUSY = replace(DEFAULT, min_user_ratings=30)
IN_DEMAND = replace(DEFAULT, lsh=LshConfig(min_item_ratings=425))
# Few and large steps instead of the 1000 small ones of the default settings.
TREES = ModelConfig(n_estimators=20, learning_rate=0.1)
# One split, on inputs of few different values: what it predicts has a closed form.
STUMP = ModelConfig(n_estimators=1, max_depth=1, subsample=1.0, colsample=1.0)
STUMP_INPUTS = ("b_price", "b_credit_card", "b_reservation", "b_table_service", "b_wheelchair", "b_is_restaurant")
SAMPLE_SIZE = 80_000
# Keys of half a per cent of the rows count as hot here, so that the plans for hot keys are taken.
HOT = SkewConfig(share=0.005, min_rows=4)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Six digits, and NULL for NaN, so that values can be compared between engines."""
    return df.withColumns({name: F.round(F.nanvl(name, F.lit(None).cast("double")), 6) for name in names})


def _facts(
    spark: SparkSession, sf_dir: str, config: Config = DEFAULT, split: str = "plain"
) -> tuple[stats.RatingFacts, DataFrame]:
    """Train ratings with their statistics, and the held-out ratings."""
    train, held_out = tables.train_and_requests(spark, sf_dir, split, written=True)
    return stats.RatingFacts(train, config), held_out


# scans and filters


def ratings_scan(spark, sf_dir):
    return tables.ratings(spark, sf_dir)


def requests_scan(spark, sf_dir):
    return tables.train_and_requests(spark, sf_dir)[1].select("user", "item")


def csv_round_trip(spark, sf_dir):
    """Ratings under text ids, written as a CSV file and read back."""
    folder = scratch_folder(spark)
    named = tables.ratings(spark, sf_dir).selectExpr("concat('u', user) AS user", "concat('i', item) AS item", "stars")
    named.write.csv(folder, header=True)
    return csv.read_ratings(spark, folder)


def csv_requests(spark, sf_dir):
    """Requests with gaps, written as a CSV file and read back: as many rows as before."""
    folder = scratch_folder(spark)
    asked = tables.train_and_requests(spark, sf_dir)[1].selectExpr(
        "if(user % 7 = 0, NULL, concat('u', user)) AS user", "if(item % 5 = 0, NULL, concat('i', item)) AS item"
    )
    asked.write.csv(folder, header=True)
    return csv.read_requests(spark, folder)


def csv_predictions(spark, sf_dir):
    """Baseline predictions written by the prediction writer, in order, and read back."""
    folder = scratch_folder(spark)
    found = baseline_predict(spark, sf_dir).withColumn("at", F.col("user") * 1_000_000 + F.col("item"))
    csv.write_predictions(found, folder, "at")
    return rounded(csv.read_predictions(spark, folder), "prediction")


def csv_left_out(spark, sf_dir):
    """Order lines as CSV, some without an item or a number of stars; both counts come with the read."""
    folder = scratch_folder(spark)
    lines = tables.order_lines(spark, sf_dir).selectExpr(
        "user", "if(item % 5 = 0, NULL, item) AS item", "if(user % 7 = 0, 'none', string(stars)) AS stars"
    )
    lines.write.csv(folder, header=True)
    seen = Observation("left out")
    kept = written(csv.read_ratings(spark, folder, seen))
    counts = seen.get
    return kept.agg(
        F.count(F.lit(1)).alias("n"), F.sum("stars").alias("sum_stars"),
        F.lit(counts["lines"]).alias("lines"), F.lit(counts["left_out"]).alias("left_out"),
    )


def _lines_in_order(spark, sf_dir, folder: str) -> None:
    """Order lines as CSV files in the order of their keys."""
    lines = tables.table(spark, sf_dir, "lineitem").join(tables.table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
    stars = (1 + F.floor((F.col("l_quantity") - 1) / 10)).cast("double").alias("stars")
    ordered = lines.orderBy("l_orderkey", "l_linenumber", "l_suppkey", stars)
    ordered.select(F.col("o_custkey").alias("user"), F.col("l_suppkey").alias("item"), stars).write.csv(folder, header=True)


def dedupe_last(spark, sf_dir):
    """Of the lines of a pair the last in the files counts."""
    folder = scratch_folder(spark)
    _lines_in_order(spark, sf_dir, folder)
    return csv.dedupe_last(csv.read_placed(spark, folder))


def csv_order(spark, sf_dir):
    """The position in the written files of every prediction that was to be in order."""
    folder = scratch_folder(spark)
    found = baseline_predict(spark, sf_dir).withColumn("at", F.col("user") * 1_000_000 + F.col("item"))
    csv.write_predictions(found, folder, "at")
    return csv.with_positions(csv.read_placed(spark, folder)).select("position", "user", "item")


def dedupe_pairs(spark, sf_dir):
    return stats.dedupe_ratings(tables.order_lines(spark, sf_dir))


def item_mean(spark, sf_dir):
    return rounded(stats.item_stats(tables.train_and_requests(spark, sf_dir)[0]), "avg_stars")


def user_mean(spark, sf_dir):
    return rounded(stats.user_stats(tables.train_and_requests(spark, sf_dir)[0]), "avg_stars")


def global_mean(spark, sf_dir):
    return rounded(stats.global_stats(tables.train_and_requests(spark, sf_dir)[0]), "avg_stars")


def _active_users(config: Config) -> Query:
    def query(spark, sf_dir):
        train, _ = tables.train_and_requests(spark, sf_dir)
        return stats.active_users(stats.user_stats(train), config)

    return query


def _popular_items(config: Config) -> Query:
    def query(spark, sf_dir):
        train, _ = tables.train_and_requests(spark, sf_dir)
        return stats.popular_items(stats.item_stats(train), config)

    return query


def _popular_ratings(config: Config) -> Query:
    def query(spark, sf_dir):
        return stats.popular_ratings(_facts(spark, sf_dir, config)[0])

    return query


def user_history(spark, sf_dir):
    return stats.user_history(tables.train_and_requests(spark, sf_dir)[0])


def item_raters(spark, sf_dir):
    return stats.item_raters(tables.train_and_requests(spark, sf_dir)[0])


def user_index(spark, sf_dir):
    return stats.user_index(stats.popular_ratings(_facts(spark, sf_dir)[0]))


def baseline_predict(spark, sf_dir):
    facts, held_out = _facts(spark, sf_dir, split="cold")
    found = stats.baseline_predict(held_out.select("user", "item"), facts)
    return rounded(found, "prediction")


# similar items


def corated_pairs(spark, sf_dir):
    return similarity.corated_pairs(_facts(spark, sf_dir)[0])


def minhash_signature(spark, sf_dir, config: Config = DEFAULT):
    facts, _ = _facts(spark, sf_dir, config)
    return lsh.minhash_signatures(lsh.band_signatures(facts), facts.config)


def _signature_of(user: str) -> Query:
    """Signatures when users have other ids, as texts or as numbers beyond 2**31."""

    def query(spark, sf_dir):
        train = written(tables.train_and_requests(spark, sf_dir)[0].withColumn("user", F.expr(user)))
        facts = stats.RatingFacts(train, DEFAULT)
        return lsh.minhash_signatures(lsh.band_signatures(facts), facts.config)

    return query


def lsh_bands(spark, sf_dir):
    facts, _ = _facts(spark, sf_dir)
    return lsh.band_keys(lsh.band_signatures(facts), facts.config)


def _lsh_candidates(config: Config, split: str = "plain") -> Query:
    def query(spark, sf_dir):
        facts, _ = _facts(spark, sf_dir, config, split)
        return similarity.candidate_pairs(facts, predict.find_buckets(facts))

    return query


def pair_moments(spark, sf_dir, config: Config = MIXED):
    facts, _ = _facts(spark, sf_dir, config)
    return predict.find_moments(facts).drop("avg_i", "avg_j")


def _pair_similarity(spark, sf_dir, config: Config = MIXED, split: str = "plain") -> DataFrame:
    facts, _ = _facts(spark, sf_dir, config, split)
    return similarity.pair_similarity(predict.find_moments(facts), facts.config)


def pair_similarity(spark, sf_dir):
    return rounded(_pair_similarity(spark, sf_dir), "sim")


def pair_similarity_blocks(spark, sf_dir):
    return rounded(_pair_similarity(spark, sf_dir, DEFAULT, "blocks"), "sim")


def similarity_edges(spark, sf_dir):
    return rounded(neighbors.similarity_edges(_pair_similarity(spark, sf_dir)), "sim")


def _top_neighbors(config: Config, split: str = "plain") -> Query:
    def query(spark, sf_dir):
        return rounded(predict.find_neighbors(_facts(spark, sf_dir, config, split)[0]), "sim")

    return query


def neighbor_count(spark, sf_dir):
    return neighbors.neighbor_count(predict.find_neighbors(_facts(spark, sf_dir, MIXED)[0]))


def hybrid_weights(spark, sf_dir):
    facts, _ = _facts(spark, sf_dir, MIXED)
    counted = neighbors.neighbor_count(predict.find_neighbors(facts))
    n = F.coalesce("neighbor_cnt", F.lit(0)).cast("bigint")
    weighed = facts.by_item.join(counted, "item", "left").select(
        "item",
        n.alias("neighbor_cnt"),
        hybrid.cf_confidence(n, MIXED).alias("cf_weight"),
        hybrid.blend_weight(n, MIXED).alias("alpha"),
    )
    return rounded(weighed, "cf_weight", "alpha")


# collaborative filtering


def common_neighbors(spark, sf_dir):
    facts, held_out = _facts(spark, sf_dir, MIXED)
    return cf.common_neighbors(held_out, facts, predict.find_neighbors(facts))


def _cf_predict(config: Config, split: str = "cold") -> Query:
    def query(spark, sf_dir):
        facts, held_out = _facts(spark, sf_dir, config, split)
        return rounded(predict.cf_predict(held_out, facts, predict.find_neighbors(facts)), "prediction")

    return query


def cf_predict_busy(spark, sf_dir):
    """Requests of users with 30 ratings and more: few enough for a sketch of them to drop ratings."""
    facts, held_out = _facts(spark, sf_dir, MIXED)
    asked = held_out.join(stats.active_users(facts.by_user, BUSY).select("user"), "user")
    return rounded(predict.cf_predict(asked, facts, predict.find_neighbors(facts)), "prediction")


# scalar rules


def fn_list_count(spark, sf_dir):
    ident = F.col("p_partkey")
    text = F.when(ident % 4 == 1, "").when(ident % 4 == 2, "None").when(
        ident % 4 == 3, F.translate("p_name", " ", ",")
    )
    part = tables.table(spark, sf_dir, "part")
    return part.select(ident.alias("id"), scalars.list_count(text).alias("n"))


def fn_safe_log1p(spark, sf_dir):
    ident = F.col("c_custkey")
    text = F.when(ident % 11 == 0, "x").otherwise(F.col("c_acctbal").cast("string"))
    customer = tables.table(spark, sf_dir, "customer")
    return rounded(customer.select(ident.alias("id"), scalars.safe_log1p(text).alias("v")), "v")


def fn_flag(spark, sf_dir):
    said = (
        F.when(F.col("l_orderkey") % 7 == 0, F.lit(None).cast("string"))
        .when(F.col("l_returnflag") == "R", "True")
        .when(F.col("l_returnflag") == "A", " yes ")
        .otherwise("no")
    )
    attributes = F.create_map(F.lit("f"), said)
    ident = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    return tables.table(spark, sf_dir, "lineitem").select(
        ident.alias("id"), scalars.flag(attributes["f"]).alias("v")
    )


def fn_price(spark, sf_dir):
    ident = F.col("p_partkey")
    text = F.when(ident % 4 == 0, "2.0").when(ident % 4 == 1, "x").when(
        ident % 4 == 3, F.col("p_size").cast("string")
    )
    return tables.table(spark, sf_dir, "part").select(ident.alias("id"), scalars.price(text).alias("v"))


def fn_finite(spark, sf_dir):
    ident = F.col("c_custkey")
    value = (
        F.when(ident % 4 == 0, float("nan"))
        .when(ident % 4 == 1, float("inf"))
        .when(ident % 4 == 2, float("-inf"))
        .otherwise(F.col("c_acctbal"))
    )
    return tables.table(spark, sf_dir, "customer").select(ident.alias("id"), scalars.finite(value).alias("v"))


# profiles and features


def _profiles(spark, sf_dir, train: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        profiles.user_features(tables.user_profile_lines(spark, sf_dir, train), "bigint"),
        profiles.item_features(tables.item_profile_lines(spark, sf_dir, train), "bigint"),
    )


def user_features(spark, sf_dir):
    train, _ = tables.train_and_requests(spark, sf_dir)
    found, _ = _profiles(spark, sf_dir, train)
    return rounded(found, "u_avg_stars")


def item_features(spark, sf_dir):
    train, _ = tables.train_and_requests(spark, sf_dir)
    _, found = _profiles(spark, sf_dir, train)
    return rounded(found, "b_avg_stars")


def _inputs(spark, sf_dir, train: DataFrame) -> tuple[DataFrame, DataFrame]:
    users, items = _profiles(spark, sf_dir, train)
    return features.model_inputs(users, "user"), features.model_inputs(items, "item")


def feature_vectors(spark, sf_dir, config: Config = DEFAULT):
    train, held_out = tables.train_and_requests(spark, sf_dir, written=True)
    users, items = _inputs(spark, sf_dir, train)
    pairs = held_out.select("user", "item")
    hot = hot_pairs(pairs, config.skew)
    found = features.with_profiles(pairs, users, items, hot.users, hot.items)
    return rounded(features.feature_vectors(found, "user", "item"), *features.FEATURES)


def _requests_without_model(spark, sf_dir, config: Config = DEFAULT) -> tuple[DataFrame, stats.RatingFacts]:
    """Requests with means and profiles, and the train ratings."""
    facts, held_out = _facts(spark, sf_dir, config)
    users, items = _inputs(spark, sf_dir, facts.ratings)
    pairs = held_out.select("user", "item")
    return predict.request_cards(pairs, facts, None, items, users), facts


def fallback_score(spark, sf_dir, config: Config = DEFAULT):
    frame, facts = _requests_without_model(spark, sf_dir, config)
    score = hybrid.fallback_score(facts.mean, facts.config)
    return rounded(frame.select("user", "item", score.alias("score")), "score")


def model_postprocess(spark, sf_dir):
    frame, facts = _requests_without_model(spark, sf_dir)
    raw = F.when((F.col("user") + F.col("item")) % 7 == 0, float("nan")).otherwise(F.col("item_avg"))
    fallback = hybrid.fallback_score(facts.mean, facts.config)
    score = hybrid.model_postprocess(raw, fallback, facts.mean, facts.config)
    return rounded(frame.select("user", "item", score.alias("prediction")), "prediction")


# predictions, evaluation, model


def _hybrid_predict(config: Config, split: str = "plain") -> Query:
    def query(spark, sf_dir):
        facts, held_out = _facts(spark, sf_dir, config, split)
        users, items = _inputs(spark, sf_dir, facts.ratings)
        lists = predict.find_neighbors(facts)
        return rounded(predict.hybrid_predict(held_out, facts, lists, users, items), "prediction")

    return query


def _evaluated_baseline(spark, sf_dir) -> DataFrame:
    facts, held_out = _facts(spark, sf_dir, split="cold")
    predicted = stats.baseline_predict(held_out.select("user", "item"), facts)
    return evaluate.evaluate(held_out, predicted)


def eval_rmse(spark, sf_dir):
    return rounded(_evaluated_baseline(spark, sf_dir).select("n", "rmse"), "rmse")


def eval_error_bins(spark, sf_dir):
    return evaluate.error_bins(_evaluated_baseline(spark, sf_dir))


def tuning_sample(spark, sf_dir):
    pairs = tables.ratings(spark, sf_dir).select("user", "item")
    return tuning.tuning_sample(pairs, SAMPLE_SIZE)


def holdout_split(spark, sf_dir):
    return tuning.holdout_split(tables.ratings(spark, sf_dir).select("user", "item"))


def cv_folds(spark, sf_dir):
    return tuning.cv_folds(tables.ratings(spark, sf_dir).select("user", "item"))


def _hot(query: Callable[[SparkSession, str, Config], DataFrame], config: Config) -> Query:
    return lambda spark, sf_dir: query(spark, sf_dir, replace(config, skew=HOT))


def model_predict(spark, sf_dir):
    facts, held_out = _facts(spark, sf_dir)
    users, items = (written(p) for p in _inputs(spark, sf_dir, facts.ratings))
    rows = predict.n_training_ratings(facts)
    fitted = model.fit(predict.training_features(facts, users, items), TREES, facts.mean_value, rows=rows)
    frame = predict.request_cards(held_out.select("user", "item"), facts, None, items, users)
    scored = predict.model_scores(frame, fitted, facts)
    return scored.select("user", "item", F.col("model_score").alias("prediction"))


def model_stump(spark, sf_dir):
    """A model of one split, fitted to all train ratings, for all requests."""
    facts, held_out = _facts(spark, sf_dir)
    users, items = (written(p) for p in _inputs(spark, sf_dir, facts.ratings))
    rows = predict.n_training_ratings(facts)
    fitted = model.fit(predict.training_features(facts, users, items), STUMP, facts.mean_value, STUMP_INPUTS, rows)
    asked = features.with_profiles(held_out.select("user", "item"), users, items, None, None)
    scored = fitted.score(features.feature_vectors(asked, "user", "item"))
    return rounded(scored.select("user", "item", F.col("model_raw").alias("prediction")), "prediction")


def _stump_search(spark, sf_dir) -> tuple[tuning.Search, DataFrame]:
    facts, _ = _facts(spark, sf_dir)
    found = predict.tuning_features(facts, *_inputs(spark, sf_dir, facts.ratings), SAMPLE_SIZE)
    train, valid = tuning.fold_and_part(found, 5, STUMP_INPUTS)
    return tuning.grid_search(train, {"n_estimators": (1,), "max_depth": (1,)}, 5, STUMP), valid


def cv_rmse_stump(spark, sf_dir):
    """Cross-validated error of a model of one split, over five folds."""
    search, _ = _stump_search(spark, sf_dir)
    return rounded(tuning.search_table(spark, search), "cv_rmse")


def holdout_rmse_stump(spark, sf_dir):
    """Error of that model on the held-out part."""
    search, valid = _stump_search(spark, sf_dir)
    return rounded(valid.select(F.count(F.lit(1)).alias("n"), F.lit(tuning.holdout_rmse(search.model, valid)).alias("rmse")), "rmse")


def end_to_end_stump_blocks(spark, sf_dir):
    """The whole plan with a fitted model of one split, where most items pass the blend's gate."""
    train, held_out = tables.train_and_requests(spark, sf_dir, "blocks", written=True)
    users, items = _profiles(spark, sf_dir, train)
    config = replace(DEFAULT, model=STUMP)
    found = predict.end_to_end(held_out.select("user", "item"), train, users, items, config, STUMP_INPUTS)
    return rounded(found, "prediction")


def training_labels(spark, sf_dir):
    """The rows the trees are fitted to: the distance of every rating to the mean, and two inputs."""
    facts, _ = _facts(spark, sf_dir)
    rows = predict.training_features(facts, *_inputs(spark, sf_dir, facts.ratings))
    label = (F.col("stars") - facts.mean).alias("label")
    return rounded(rows.select("user", "item", label, "b_review_cnt", "u_review_cnt"), "label", "b_review_cnt", "u_review_cnt")


def tuning_features(spark, sf_dir):
    """The inputs of the sampled ratings, with their part and fold."""
    facts, _ = _facts(spark, sf_dir)
    found = predict.tuning_features(facts, *_inputs(spark, sf_dir, facts.ratings), SAMPLE_SIZE)
    marked = tuning.cv_folds(tuning.holdout_split(found))
    return rounded(marked.select("user", "item", "stars", "part", "fold", "b_review_cnt", "u_review_cnt"), "b_review_cnt", "u_review_cnt")


def end_to_end_predict(spark, sf_dir):
    train, held_out = tables.train_and_requests(spark, sf_dir, written=True)
    users, items = _profiles(spark, sf_dir, train)
    config = replace(MIXED, model=TREES)
    return predict.end_to_end(held_out.select("user", "item"), train, users, items, config)


# The plans for hot keys; their SQL twins are those of the plain queries.
HOT_QUERIES: dict[str, Query] = {
    "minhash_signature_hot": _hot(minhash_signature, DEFAULT),
    "pair_moments_hot": _hot(pair_moments, MIXED),
    "cf_predict_hot": _cf_predict(replace(MIXED, skew=HOT)),
    "feature_vectors_hot": _hot(feature_vectors, DEFAULT),
    "fallback_score_hot": _hot(fallback_score, DEFAULT),
}

def end_to_end_answers(spark, sf_dir):
    """Every request, and whether its prediction is a rating from 1 to 5."""
    answered = end_to_end_predict(spark, sf_dir)
    return answered.select("user", "item", F.coalesce(F.col("prediction").between(1, 5), F.lit(False)).alias("in_range"))


QUERIES: dict[str, Query] = {
    "ratings_scan": ratings_scan,
    "requests_scan": requests_scan,
    "csv_round_trip": csv_round_trip,
    "csv_requests": csv_requests,
    "csv_predictions": csv_predictions,
    "csv_left_out": csv_left_out,
    "dedupe_last": dedupe_last,
    "csv_order": csv_order,
    "dedupe_pairs": dedupe_pairs,
    "item_mean": item_mean,
    "user_mean": user_mean,
    "global_mean": global_mean,
    "active_users": _active_users(DEFAULT),
    "active_users_busy": _active_users(BUSY),
    "popular_items": _popular_items(DEFAULT),
    "popular_items_in_demand": _popular_items(IN_DEMAND),
    "popular_ratings": _popular_ratings(DEFAULT),
    "popular_ratings_in_demand": _popular_ratings(IN_DEMAND),
    "user_history": user_history,
    "item_raters": item_raters,
    "user_index": user_index,
    "baseline_predict": baseline_predict,
    "corated_pairs": corated_pairs,
    "minhash_signature": minhash_signature,
    "minhash_signature_text_ids": _signature_of("concat('u', user)"),
    "minhash_signature_wide_ids": _signature_of(f"user * {HASH_PRIME}L"),
    "lsh_bands": lsh_bands,
    "lsh_candidates": _lsh_candidates(DEFAULT),
    "lsh_candidates_mixed": _lsh_candidates(MIXED),
    "lsh_candidates_dense": _lsh_candidates(DENSE),
    "lsh_candidates_casual": _lsh_candidates(CASUAL),
    "pair_moments": pair_moments,
    "pair_similarity": pair_similarity,
    "similarity_edges": similarity_edges,
    "top_neighbors": _top_neighbors(DENSE),
    "top_neighbors_mixed": _top_neighbors(MIXED),
    "neighbor_count": neighbor_count,
    "hybrid_weights": hybrid_weights,
    "common_neighbors": common_neighbors,
    "cf_predict": _cf_predict(MIXED),
    "cf_predict_dense": _cf_predict(DENSE),
    "fn_list_count": fn_list_count,
    "fn_safe_log1p": fn_safe_log1p,
    "fn_flag": fn_flag,
    "fn_price": fn_price,
    "fn_finite": fn_finite,
    "user_features": user_features,
    "item_features": item_features,
    "feature_vectors": feature_vectors,
    "fallback_score": fallback_score,
    "model_postprocess": model_postprocess,
    "hybrid_predict": _hybrid_predict(MIXED),
    "eval_rmse": eval_rmse,
    "eval_error_bins": eval_error_bins,
    "tuning_sample": tuning_sample,
    "holdout_split": holdout_split,
    "cv_folds": cv_folds,
    **HOT_QUERIES,
    "lsh_candidates_blocks": _lsh_candidates(DEFAULT, "blocks"),
    "pair_similarity_blocks": pair_similarity_blocks,
    "top_neighbors_blocks": _top_neighbors(DEFAULT, "blocks"),
    "cf_predict_blocks": _cf_predict(DEFAULT, "blocks"),
    "hybrid_predict_blocks": _hybrid_predict(DEFAULT, "blocks"),
    "model_predict": model_predict,
    "cf_predict_busy": cf_predict_busy,
    "model_stump": model_stump,
    "cv_rmse_stump": cv_rmse_stump,
    "holdout_rmse_stump": holdout_rmse_stump,
    "end_to_end_stump_blocks": end_to_end_stump_blocks,
    "training_labels": training_labels,
    "tuning_features": tuning_features,
    "end_to_end_predict": end_to_end_predict,
    "end_to_end_answers": end_to_end_answers,
}
