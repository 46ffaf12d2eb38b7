"""Collaborative filtering, blending and evaluation on worked examples."""

import math
from dataclasses import replace

import pytest
from conftest import as_dict, row_set
from data import one_bucket, ratings
from pyspark.sql import functions as F

from starwise.config import Config
from starwise.operators import cf, evaluate, hybrid
from starwise.operators.stats import RatingFacts
from starwise.plans import predict

PAIR = "user string, item string"


@pytest.fixture(scope="module")
def facts(golden):
    return RatingFacts(golden, Config())


@pytest.fixture(scope="module")
def lists(facts):
    return predict.find_neighbors(facts, one_bucket(facts)).cache()


def test_golden_predictions(spark, facts, lists):
    asked = [("u2", "C"), ("u2", "D"), ("u4", "A"), ("u4", "C"), ("u5", "B"), ("u9", "B"), ("u1", "Z"), ("u2", "C")]
    found = as_dict(predict.cf_predict(spark.createDataFrame(asked, PAIR), facts, lists), "user", "item")
    got = {k: (r.n_common, round(r.prediction, 6), r.reason) for k, r in found.items()}
    assert got == {
        ("u2", "C"): (2, 1.0, "weighted"),
        ("u2", "D"): (2, 3.0, "zero_weight"),
        ("u4", "A"): (1, 3.00875, "weighted"),
        ("u4", "C"): (1, 1.0, "weighted"),
        ("u5", "B"): (2, 1.0, "weighted"),
        ("u9", "B"): (0, 3.5, "new_user"),
        ("u1", "Z"): (0, 3.166667, "no_neighbors"),
    }


def test_no_common_neighbor(spark):
    rows = [("a", "x", 5.0), ("a", "y", 1.0), ("b", "x", 1.0), ("b", "y", 5.0), ("c", "z", 2.0)]
    facts = RatingFacts(spark.createDataFrame(rows, "user string, item string, stars double"), Config())
    lists = predict.find_neighbors(facts, one_bucket(facts))
    asked = spark.createDataFrame([("c", "x")], PAIR)
    row = predict.cf_predict(asked, facts, lists).first()
    assert (row.reason, row.prediction, row.n_common) == ("no_common", 3.0, 0)
    assert cf.common_neighbors(asked, facts, lists).count() == 0


@pytest.mark.parametrize(
    ("n", "confidence", "alpha"), [(25, 0.824949, 0.161963), (30, 0.828094, 0.163195), (35, 0.830636, 0.16418)]
)
def test_blend_weights(spark, n, confidence, alpha):
    row = spark.range(1).select(
        hybrid.cf_confidence(F.lit(n), Config()).alias("c"), hybrid.blend_weight(F.lit(n), Config()).alias("a")
    ).first()
    assert (round(row.c, 6), round(row.a, 6)) == (confidence, alpha)


@pytest.mark.parametrize("n", [24, 25])
def test_gate(spark, n):
    frame = spark.createDataFrame([(n, 3.0, 4.0)], "neighbor_cnt long, item_avg double, user_avg double")
    got = frame.select(hybrid.hybrid_score(F.lit(2.0), F.lit(5.0), F.lit(3.5), Config())).first()[0]
    score = 2.0
    if n >= 25:
        p = math.log1p(n)
        trust, alpha = 0.7 + 0.24 * p / (p + 3), 0.1 + 0.1 * p / (p + 2)
        score = alpha * (trust * 5.0 + (1 - trust) * 3.5) + (1 - alpha) * 2.0
    assert got == pytest.approx(0.98 * score + 0.02 * 3.5)


def test_postprocess_and_fallback(spark):
    rows = [(float("nan"), 2.0, 4.0, None, 5.0), (7.0, 2.0, 4.0, None, 5.0), (3.0, None, None, None, None)]
    frame = spark.createDataFrame(rows, "raw double, item_avg double, user_avg double, item_stars double, user_stars double")
    mean = F.lit(3.0)
    fallback = hybrid.fallback_score(mean, Config())
    got = [r[0] for r in frame.select(hybrid.model_postprocess(F.col("raw"), fallback, mean, Config())).collect()]
    expected = 0.5 * ((0.7 * 2 + 0.3 * 3) + (0.7 * 4 + 0.3 * 5))
    assert got == pytest.approx([0.97 * expected + 0.09, 5.0, 3.0])


def test_copies_of_a_request_are_all_answered(spark):
    asked = spark.createDataFrame([("a", "x")] * 50 + [("b", "x")], PAIR).repartition(3)
    answers = spark.createDataFrame([("a", "x", 2.0), ("b", "x", 3.0)], PAIR + ", prediction double")
    plain = row_set(predict.answer_all(asked, answers, Config(), 3.0))
    skewed = Config(skew=replace(Config().skew, min_rows=7, share=0.01))
    assert plain == row_set(predict.answer_all(asked, answers, skewed, 3.0))
    assert len(plain) == 51


def test_evaluation(spark):
    truth = [("a", str(k), 1.0) for k in range(6)] + [("a", "missing", 5.0), ("a", "0", 0.5)]
    scores = [1.0, 2.0, 3.0, 4.0, 5.0, 1.25]
    predicted = [("a", str(k), s) for k, s in enumerate(scores)]
    got = evaluate.evaluate(
        spark.createDataFrame(truth, PAIR + ", stars double"),
        spark.createDataFrame(predicted, PAIR + ", prediction double"),
    )
    row = got.first()
    errors = [s - 1 for s in scores]
    assert row.n == 6 and row.rmse == pytest.approx(math.sqrt(sum(e * e for e in errors) / 6))
    bins = as_dict(evaluate.error_bins(got), "bin")
    assert {k: r.n for k, r in bins.items()} == {0: 2, 1: 1, 2: 1, 3: 1, 4: 1}


def test_evaluation_without_matches(spark):
    empty = spark.createDataFrame([], PAIR + ", prediction double")
    truth = spark.createDataFrame([("a", "x", 1.0)], PAIR + ", stars double")
    row = evaluate.evaluate(truth, empty).first()
    assert (row.n, row.rmse, row.bin_0) == (0, None, 0)


def test_predictions_cover_every_request_within_bounds(spark):
    rows = ratings(users=80, items=30)
    held = [r for k, r in enumerate(rows) if k % 7 == 0] + [(999, 3, 1.0), (3, 999, 1.0)]
    train = [r for k, r in enumerate(rows) if k % 7]
    schema = "user long, item long, stars double"
    facts = RatingFacts(spark.createDataFrame(train, schema), Config())
    asked = spark.createDataFrame(held, schema)
    lists = predict.find_neighbors(facts, one_bucket(facts))
    found = as_dict(predict.cf_predict(asked, facts, lists), "user", "item")
    assert found.keys() == {(u, i) for u, i, _ in held}
    assert all(1 <= r.prediction <= 5 for r in found.values())
