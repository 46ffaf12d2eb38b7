"""Hot keys: the cut plans give the rows of the plain ones."""

from dataclasses import replace

import pytest
from conftest import as_dict, row_set
from data import one_bucket, ratings

from starwise.config import Config, LshConfig, SkewConfig
from starwise.operators import cf, lsh, neighbors, similarity
from starwise.operators.stats import RatingFacts, popular_ratings
from starwise.plans import predict
from starwise.skew import hot_keys, hot_pairs, key_counts, lookup, split_fact

LONG = "user long, item long, stars double"
PLAIN = Config(lsh=LshConfig(bands=8, rows=2, min_item_ratings=5))
HOT = replace(PLAIN, skew=SkewConfig(share=0.005, min_rows=4))


@pytest.fixture(scope="module")
def fact(spark):
    rows = [("hot", k) for k in range(300)] + [(f"k{k}", k) for k in range(100)]
    return spark.createDataFrame(rows, "key string, v long")


def test_hot_keys_are_few_and_sized(fact):
    hot = hot_keys(key_counts(fact, "key"), ["key"], 400, SkewConfig(share=0.1, min_rows=10))
    assert [tuple(r) for r in hot.collect()] == [("hot", 300, 8)]
    assert hot_keys(key_counts(fact, "key"), ["key"], 400, SkewConfig()) is None
    assert hot_keys(key_counts(fact, "key"), ["key"], 400, SkewConfig(share=0.9, min_rows=1)) is None


def test_hot_rows_are_spread(spark, fact):
    hot = spark.createDataFrame([("hot", 8)], "key string, pieces int")
    sizes = as_dict(key_counts(split_fact(fact, hot, ["key"], ["v"]), "key", "salt"), "key", "salt")
    pieces = [r.n for (key, _), r in sizes.items() if key == "hot"]
    assert len(pieces) == 8 and max(pieces) < 100
    assert {salt for key, salt in sizes if key != "hot"} == {0}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_keeps_the_result(spark, fact, how):
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("other", 3)], "key string, w int")
    hot = spark.createDataFrame([("hot", 8), ("k1", 2)], "key string, pieces int")
    assert row_set(lookup(fact, dim, "key", hot, ["v"], how)) == row_set(lookup(fact, dim, "key", None, ["v"], how))


@pytest.fixture(scope="module")
def both(spark):
    rows = ratings(users=80) + [(user, 500, 3.0) for user in range(80)]
    df = spark.createDataFrame(rows, LONG)
    plain, hot = RatingFacts(df, PLAIN), RatingFacts(df, HOT)
    assert plain.hot_items is None and plain.hot_users is None
    assert hot.hot_items is not None and hot.hot_users is not None
    return plain, hot


def test_signatures_of_hot_items(both):
    plain, hot = (row_set(lsh.band_signatures(facts)) for facts in both)
    assert plain == hot


def test_popular_ratings_of_hot_items(both):
    plain, hot = (row_set(popular_ratings(facts)) for facts in both)
    assert plain == hot


def test_hot_buckets(both):
    plain, hot = (row_set(predict.find_buckets(facts)) for facts in both)
    assert plain == hot


def test_moments_with_hot_items(both):
    plain, hot = (row_set(predict.find_moments(facts)) for facts in both)
    assert plain == hot and plain
    plain, hot = (row_set(similarity.corated_pairs(facts)) for facts in both)
    assert plain == hot


def test_predictions_with_hot_requests(spark, both):
    asked = spark.createDataFrame(
        [(u, i) for u in range(0, 90, 3) for i in (0, 1, 2)] + [(5, i) for i in range(16)], "user long, item long"
    )
    lists = predict.find_neighbors(both[0], one_bucket(both[0])).cache()
    plain, hot = (row_set(predict.cf_predict(asked, facts, lists)) for facts in both)
    assert plain == hot


def test_hot_neighbors_of_hot_users(spark, both):
    asked = spark.createDataFrame([(5, item) for item in range(30)] + [(6, 1)], "user long, item long")
    lists = spark.createDataFrame([(item, 40, 0.5) for item in range(30)], "item long, nbr long, sim double")
    packed = neighbors.packed_neighbors(lists)
    config = replace(HOT, top_k=1)
    found = hot_pairs(asked, config.skew)
    opened = cf.open_requests(asked, packed, found.items)
    keys = cf.hot_neighbors(opened, found, config)
    assert [(r.user, r.nbr, r.n) for r in keys.collect()] == [(5, 40, 30)]
    rated = spark.createDataFrame([(5, 40, 4.0), (6, 40, 1.0)], LONG)
    hot = cf.rated_neighbors(asked, packed, found, RatingFacts(rated, config))
    plain = cf.rated_neighbors(asked, packed, hot_pairs(asked, PLAIN.skew), RatingFacts(rated, PLAIN))
    assert row_set(hot) == row_set(plain) and plain.count() == 31


def test_no_plan_pairs_everything(both):
    facts = both[1]
    plan = predict.find_neighbors(facts)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan


def test_item_mean_is_partially_aggregated(both):
    from starwise.operators.stats import item_stats

    plan = item_stats(both[0].ratings)._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan
