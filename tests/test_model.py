"""The regressor, sampling, splitting and tuning."""

import math
import random
from dataclasses import replace

import pytest
from conftest import row_set

from starwise.config import ModelConfig
from starwise.operators import model, tuning
from starwise.operators.features import FEATURES

FAST = ModelConfig(n_estimators=8, max_depth=3, learning_rate=0.3)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for k in range(1200):
        x = [rng.random() for _ in FEATURES]
        stars = min(5.0, max(1.0, 1 + 3 * x[0] + (x[10] > 0.5) + rng.gauss(0, 0.2)))
        data.append((k % 40, k // 40, stars, *x))
    schema = "user long, item long, stars double, " + ", ".join(f"{name} double" for name in FEATURES)
    return spark.createDataFrame(data, schema).cache()


def rmse(scored):
    return math.sqrt(sum((r.stars - r.model_raw) ** 2 for r in scored) / len(scored))


def test_model_beats_the_mean_and_repeats_itself(rows):
    mean = 2.9
    scored = model.fit(rows, FAST, mean).score(rows).collect()
    assert all(math.isfinite(r.model_raw) for r in scored)
    flat = math.sqrt(sum((r.stars - mean) ** 2 for r in scored) / len(scored))
    assert rmse(scored) < 0.6 * flat
    again = model.fit(rows, FAST, mean).score(rows)
    assert row_set(again.select("user", "item", "model_raw")) == sorted(
        (r.item, round(r.model_raw, 9), r.user) for r in scored
    )


def test_tasks_of_a_fit_follow_its_rows(spark, rows, monkeypatch):
    """A level of a tree is a job over all parts: few rows take few tasks however many parts a shuffle has."""
    monkeypatch.setattr(model, "ROWS_PER_TASK", 100)
    cores, sc = spark.sparkContext.defaultParallelism, spark.sparkContext
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        parts = {n: model.on_all_cores(rows, n).rdd.getNumPartitions() for n in (None, 0, 1200, 1201, 10**9)}
        sc.setJobGroup("fit", "a fit")
        model.fit(rows, FAST, 2.9, rows=1200)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert parts == {None: 64, 0: 2 * cores, 1200: 3 * cores, 1201: 4 * cores, 10**9: 64}
    status = sc.statusTracker()
    infos = [status.getStageInfo(s) for job in status.getJobIdsForGroup("fit") for s in status.getJobInfo(job).stageIds]
    sizes = [info.numTasks for info in infos if info is not None]
    assert len(sizes) > FAST.n_estimators * FAST.max_depth and max(sizes) <= 3 * cores


def test_training_rows_are_spread_once_and_leave_memory_to_the_trees(spark, rows, monkeypatch):
    seen = []

    class Watch:
        def fit(self, given):
            seen.append((given.storageLevel, given))

    monkeypatch.setattr(model, "estimator", lambda settings: Watch())
    model.fit(rows, FAST, 2.9, rows=1200)
    level, given = seen[0]
    assert level.useDisk and not level.useMemory
    assert not given.storageLevel.useDisk  # given back after the fit


def test_estimator_takes_every_setting():
    settings = {p.name: v for p, v in model.estimator(ModelConfig()).extractParamMap().items()}
    expected = {
        "maxIter": 1000, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8,
        "featureSubsetStrategy": "0.7", "minInstancesPerNode": 4, "seed": 42,
    }
    assert expected.items() <= settings.items()


@pytest.mark.parametrize("size", [0, 1, 100, 5000, 20000])
def test_sample_has_its_size_and_is_stable(spark, size):
    pairs = spark.range(10000).selectExpr("id AS user", "id % 7 AS item")
    found = tuning.tuning_sample(pairs, size)
    assert found.count() == min(size, 10000)
    assert row_set(found) == row_set(tuning.tuning_sample(pairs.repartition(5), size))


def test_split_is_about_one_in_five(spark):
    pairs = spark.range(10000).selectExpr("id AS user", "id % 7 AS item")
    parts = {r.part: r["count"] for r in tuning.holdout_split(pairs).groupBy("part").count().collect()}
    assert sum(parts.values()) == 10000 and abs(parts["valid"] - 2000) < 200


def test_split_of_a_thin_sample_is_about_one_in_five(spark):
    pairs = spark.range(200_000).selectExpr("id AS user", "id % 7 AS item")
    thin = tuning.tuning_sample(pairs, 2000)
    assert abs(tuning.holdout_split(thin).where("part = 'valid'").count() - 400) < 80
    folds = {r.fold: r["count"] for r in tuning.cv_folds(tuning.holdout_split(thin).where("part = 'train'")).groupBy("fold").count().collect()}
    assert set(folds) == set(range(5)) and min(folds.values()) > 240


@pytest.mark.parametrize(
    ("value", "choices", "near"),
    [
        (0.05, (0.03, 0.04, 0.05, 0.06), [0.05]),
        (0.07, (0.03, 0.04, 0.05, 0.06), [0.05, 0.06]),
        (600, (800, 900, 1000, 1100), [800, 900]),
        (2, (3, 4, 5), [3, 4]),
    ],
)
def test_around(value, choices, near):
    assert tuning.around(value, choices) == near


def test_fine_grid_fixes_the_sampling_shares():
    best = {"learning_rate": 0.03, "max_depth": 6, "n_estimators": 600, "min_child_weight": 2, "subsample": 0.7}
    grid = tuning.fine_grid(best)
    assert grid["n_estimators"] == [800, 900] and grid["subsample"] == [0.8] and grid["colsample"] == [0.7]
    assert math.prod(len(v) for v in tuning.COARSE_GRID.values()) == 324


def test_two_stage_tuning(spark, rows):
    coarse = {"learning_rate": (0.01, 0.3), "max_depth": (2,)}
    base = replace(FAST, n_estimators=4)
    fine = {"learning_rate": (0.3, 0.5), "colsample": (0.7,)}
    tuned = tuning.tune(rows, coarse, folds=2, base=base, fine=fine)
    assert tuned.coarse.best["learning_rate"] == 0.3
    assert len(tuned.fine.points) == 2 and tuned.holdout_rmse > 0
    assert tuned.config(base).learning_rate in (0.3, 0.5)
    table = tuning.search_table(spark, tuned.fine)
    assert table.columns == ["learning_rate", "colsample", "cv_rmse"] and table.count() == 2
    assert min(tuned.fine.rmse) == pytest.approx(tuned.fine.rmse[tuned.fine.points.index(tuned.fine.best)])


def test_points_that_differ_in_trees_share_a_fit(spark, rows):
    train, _ = tuning.fold_and_part(rows, 2)
    grid = {"max_depth": (1, 2), "n_estimators": (2, 5, 3)}
    search = tuning.grid_search(train, grid, 2, FAST)
    assert search.fits == 2 * 2 + 1
    assert [(p["max_depth"], p["n_estimators"]) for p in search.points] == [(d, n) for d in (1, 2) for n in (2, 5, 3)]
    for point, found in zip(search.points, search.rmse):
        mse = []
        for fold in range(2):
            fitted = model.estimator(replace(FAST, **point)).fit(train.where(f"fold <> {fold}"))
            mse.append(tuning.holdout_rmse(fitted, train.where(f"fold = {fold}")) ** 2)
        assert found == pytest.approx(math.sqrt(sum(mse) / 2))
    assert search.best == search.points[search.rmse.index(min(search.rmse))]
    assert search.model.getNumTrees == search.best["n_estimators"]


def test_training_rows_are_bounded(spark):
    from starwise.config import Config
    from starwise.operators.stats import RatingFacts
    from starwise.plans import predict

    ratings = spark.range(20_000).selectExpr("id AS user", "id % 40 AS item", "1.0D + id % 5 AS stars")
    for most, low, high in ((50_000, 20_000, 20_000), (2_000, 1_700, 2_300)):
        config = Config(model=replace(FAST, max_training_rows=most))
        assert low <= predict.training_ratings(RatingFacts(ratings, config)).count() <= high


@pytest.mark.parametrize("query", ["end_to_end_predict", "end_to_end_stump_blocks", "model_predict", "job"])
def test_all_ratings_are_learned_from_however_many(spark, query):
    from pyspark.sql import Row

    from catalog import queries
    from starwise.config import Config
    from starwise.operators.stats import RatingFacts
    from starwise.plans import predict

    config = {
        "end_to_end_predict": replace(queries.MIXED, model=queries.TREES),
        "end_to_end_stump_blocks": replace(queries.DEFAULT, model=queries.STUMP),
        "model_predict": queries.DEFAULT,  # of the facts; the trees' settings have no part in it
        "job": Config(),
    }[query]
    ratings = spark.range(2_000).selectExpr("id AS user", "id % 40 AS item", "1.0D + id % 5 AS stars")
    facts = RatingFacts(ratings, config)
    facts._totals = Row(avg_stars=3.0, n=10**10)  # as if there were so many
    assert predict.training_ratings(facts).count() == 2_000
    assert predict.n_training_ratings(facts) == 10**10


@pytest.mark.parametrize("most", [50_000, 100])
def test_end_to_end_tells_the_fit_how_many_rows_there_are(spark, monkeypatch, most):
    from starwise.config import Config
    from starwise.plans import predict
    from starwise.sources.profiles import ITEM_FEATURES, USER_FEATURES

    class Fitted(Exception):
        pass

    def fit(features, settings, base_score, inputs=FEATURES, rows=None):
        raise Fitted(rows)

    monkeypatch.setattr(model, "fit", fit)
    ratings = spark.range(200).selectExpr("id % 20 AS user", "id div 20 AS item", "1.0D + id % 5 AS stars")
    users, items = (
        ratings.select(key).distinct().selectExpr(key, *[f"1.0D AS {name}" for name in names], "true AS record_ok")
        for key, names in (("user", USER_FEATURES), ("item", ITEM_FEATURES))
    )
    with pytest.raises(Fitted) as told:
        predict.end_to_end(ratings.select("user", "item"), ratings, users, items, Config(model=replace(FAST, max_training_rows=most)))
    assert told.value.args == (min(200, most),)
