"""Deterministic sampling and splitting, and the two-stage grid search."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starwise.config import ModelConfig
from starwise.functions.scalars import pair_hash
from starwise.operators.features import FEATURES
from starwise.operators.model import estimator, on_all_cores, training_set
from starwise.runtime import written

HASH_SPACE = 2**60

# The coarse grid, and the choices of the fine grid around its best point.
COARSE_GRID: Mapping[str, Sequence[float]] = {
    "learning_rate": (0.03, 0.05, 0.07),
    "max_depth": (4, 5, 6),
    "n_estimators": (600, 800, 1000),
    "subsample": (0.7, 0.8),
    "colsample": (0.6, 0.7, 0.8),
    "min_child_weight": (2, 4),
}
FINE_CHOICES: Mapping[str, Sequence[float]] = {
    "learning_rate": (0.03, 0.04, 0.05, 0.06),
    "max_depth": (4, 5, 6),
    "n_estimators": (800, 900, 1000, 1100),
    "min_child_weight": (3, 4, 5),
}
FINE_FIXED: Mapping[str, Sequence[float]] = {"subsample": (0.8,), "colsample": (0.7,)}


def tuning_sample(pairs: DataFrame, size: int = 80_000, total: int | None = None) -> DataFrame:
    """The ``size`` pairs with the lowest hash: a sample without replacement, the same every time.

    Rows whose hash lies well above the ``size``-th lowest expected one are dropped by a plain
    filter, ten standard deviations clear of it, so that the final sort sees about ``size`` rows
    however many there are. The rows that pass are written once, so ``pairs`` is computed for them
    and, unless the ``total`` of its rows is given, for that count. Should fewer than ``size`` pass,
    the sort sees all rows.
    """
    slack = size + 10 * math.sqrt(size) + 100
    if total is None:
        total = pairs.count()
    hashed = pairs.withColumn("order", pair_hash(F.col("user"), F.col("item")))
    low = hashed.where(F.col("order") < float(HASH_SPACE) * slack / max(total, 1))
    low = written(low)
    if low.count() < min(size, total):
        low = hashed
    return low.orderBy("order", "user", "item").limit(size).drop("order")


def holdout_split(pairs: DataFrame, valid_percent: int = 20) -> DataFrame:
    """``part`` is 'valid' for about ``valid_percent`` in 100 pairs, else 'train'.

    Other digits than those that draw the sample decide, so the share holds in any sample.
    """
    hashed = pair_hash(F.col("user"), F.col("item"), start=17)
    return pairs.withColumn("part", F.when(hashed % 100 < valid_percent, "valid").otherwise("train"))


def around(value: float, choices: Sequence[float]) -> list[float]:
    """``value`` itself if it is a choice, else the two choices closest to it."""
    if value in choices:
        return [value]
    return sorted(sorted(choices, key=lambda choice: abs(choice - value))[:2])


def fine_grid(best: Mapping[str, float]) -> dict[str, list[float]]:
    near = {name: around(best[name], choices) for name, choices in FINE_CHOICES.items()}
    return near | {name: list(values) for name, values in FINE_FIXED.items()}


@dataclass(frozen=True)
class Search:
    """Outcome of one grid search: all points with their RMSE, the best one and its model.

    ``fits`` counts the models fitted on the way, the last one included.
    """

    points: list[dict[str, float]]
    rmse: list[float]
    best: dict[str, float]
    model: GBTRegressionModel
    fits: int


def prefix_mse(model: GBTRegressionModel, rows: DataFrame, counts: Sequence[int]) -> list[float]:
    """Mean squared error on ``rows`` of the first ``counts`` trees of a model, in one pass.

    Boosting adds trees one by one and each depends on those before it alone, so the first n trees
    of a longer fit are the model that a fit of n trees gives.
    """
    after = model.evaluateEachIteration(rows, "squared")
    return [after[count - 1] for count in counts]


def grid_search(
    train: DataFrame,
    grid: Mapping[str, Sequence[float]],
    folds: int = 5,
    base: ModelConfig | None = None,
    parallelism: int = 4,
) -> Search:
    """Cross-validate every grid point on ``train`` (features, label, fold).

    The score is the square root of the mean squared error over the folds' means. Points that
    differ in their number of trees alone are scored off one fit per fold, that of the most trees;
    of points of equal score the first in grid order wins.
    """
    base = base or ModelConfig()
    names = list(grid)
    points = [dict(zip(names, values)) for values in product(*grid.values())]
    counts = sorted(set(grid.get("n_estimators", (base.n_estimators,))))
    shapes = [dict(zip(names, v)) for v in product(*(("",) if n == "n_estimators" else grid[n] for n in names))]
    parts = [train.where(F.col("fold") == fold) for fold in range(folds)]
    rests = [train.where(F.col("fold") != fold).persist(StorageLevel.MEMORY_AND_DISK) for fold in range(folds)]

    def scores(job: tuple[int, int]) -> list[float]:
        shape, fold = job
        regressor = estimator(replace(base, **(shapes[shape] | {"n_estimators": counts[-1]})))
        return prefix_mse(regressor.fit(rests[fold]), parts[fold], counts)

    jobs = list(product(range(len(shapes)), range(folds)))
    try:
        with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
            found = dict(zip(jobs, pool.map(inheritable_thread_target(scores), jobs)))
    finally:
        for rest in rests:
            rest.unpersist()
    mse: dict[tuple[float, ...], float] = {}
    for n, shape in enumerate(shapes):
        for k, count in enumerate(counts):
            point = shape | ({"n_estimators": count} if "n_estimators" in grid else {})
            mse[tuple(point[name] for name in names)] = sum(found[n, fold][k] for fold in range(folds)) / folds
    rmse = [math.sqrt(mse[tuple(point.values())]) for point in points]
    best = points[rmse.index(min(rmse))]
    return Search(points, rmse, best, estimator(replace(base, **best)).fit(train), len(jobs) + 1)


def search_table(spark: SparkSession, search: Search) -> DataFrame:
    """One row per grid point with its ``cv_rmse``."""
    names = list(search.points[0])
    rows = [(*point.values(), rmse) for point, rmse in zip(search.points, search.rmse)]
    return spark.createDataFrame(rows, [*names, "cv_rmse"])


def holdout_rmse(model: GBTRegressionModel, valid: DataFrame) -> float:
    scored = model.transform(valid)
    return RegressionEvaluator(labelCol="label", predictionCol="offset", metricName="rmse").evaluate(scored)


@dataclass(frozen=True)
class Tuned:
    coarse: Search
    fine: Search
    holdout_rmse: float

    def config(self, base: ModelConfig) -> ModelConfig:
        return replace(base, **self.fine.best)


def cv_folds(pairs: DataFrame, folds: int = 5) -> DataFrame:
    """``pairs`` with ``fold``, 0 to ``folds`` - 1, by a hash of its own."""
    return pairs.withColumn("fold", (pair_hash(F.col("item"), F.col("user")) % folds).cast("int"))


def fold_and_part(features: DataFrame, folds: int, inputs: Sequence[str] = FEATURES) -> tuple[DataFrame, DataFrame]:
    """Train rows with their fold and validation rows, both as (features, label)."""
    rows = cv_folds(holdout_split(on_all_cores(features)), folds)
    ready = written(rows.select(*FEATURES, "stars", "fold", "part"))
    base_score = ready.where("part = 'train'").agg(F.avg("stars")).first()[0]
    train = ready.where("part = 'train'")
    labelled = training_set(train, base_score, "fold", inputs=inputs)
    return labelled, training_set(ready.where("part = 'valid'"), base_score, inputs=inputs)


def tune(
    features: DataFrame,
    coarse: Mapping[str, Sequence[float]] = COARSE_GRID,
    folds: int = 5,
    base: ModelConfig | None = None,
    fine: Mapping[str, Sequence[float]] | None = None,
) -> Tuned:
    """Coarse search, fine search around its best point, and the RMSE on held-out rows.

    ``features`` has user, item, stars and the 22 inputs of the sampled ratings. ``fine`` replaces
    the default fine grid.
    """
    train, valid = fold_and_part(features, folds)
    first = grid_search(train, coarse, folds, base)
    second = grid_search(train, fine or fine_grid(first.best), folds, base)
    return Tuned(first, second, holdout_rmse(second.model, valid))
