"""Boosted-tree regression on the profile features."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwise.config import ModelConfig
from starwise.operators.features import FEATURES
from starwise.runtime import ensure_checkpoint_dir


def estimator(model: ModelConfig) -> GBTRegressor:
    """The one regressor used for the final fit and for tuning.

    Columns are drawn per tree node here. Spark's trees have no L1 or L2 penalty on leaf values.
    """
    return GBTRegressor(
        featuresCol="features",
        labelCol="label",
        predictionCol="offset",
        lossType="squared",
        maxIter=model.n_estimators,
        maxDepth=model.max_depth,
        stepSize=model.learning_rate,
        subsamplingRate=model.subsample,
        featureSubsetStrategy=str(model.colsample),
        minInstancesPerNode=model.min_child_weight,
        seed=model.seed,
        checkpointInterval=10,
    )


def assemble(features: DataFrame, inputs: Sequence[str] = FEATURES) -> DataFrame:
    """The inputs (all 22) as the vector column ``features``; other columns stay."""
    return (
        VectorAssembler(inputCols=list(inputs), outputCol="features")
        .transform(features)
        .drop(*FEATURES)
    )


def training_set(features: DataFrame, base_score: float, *kept: str, inputs: Sequence[str] = FEATURES) -> DataFrame:
    """(features, label) and the kept columns: the label is the distance to the base score."""
    label = (F.col("stars") - base_score).alias("label")
    return assemble(features, inputs).select("features", label, *kept)


@dataclass(frozen=True)
class RatingModel:
    """A fitted regressor, the score its trees start from and the inputs it looks at."""

    trees: GBTRegressionModel
    base_score: float
    inputs: Sequence[str] = FEATURES

    def score(self, features: DataFrame, column: str = "model_raw") -> DataFrame:
        """``features`` with the raw model score in ``column``, scored where the rows are."""
        scored = self.trees.transform(assemble(features, self.inputs))
        return scored.withColumn(column, F.col("offset") + self.base_score).drop("features", "offset")


# Rows that one task of a fit holds, at most about. A tree level is a job over all of them, so smaller tasks cost
# more to start than their rows cost to count.
ROWS_PER_TASK = 1 << 18


def on_all_cores(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` spread over as many partitions as the session shuffles into, at least one per core.

    If its number of ``rows`` is known, fewer do where that leaves each about ``ROWS_PER_TASK`` rows or
    fewer: as many per core as it takes, and two at least.
    """
    session = df.sparkSession
    cores = session.sparkContext.defaultParallelism
    wanted = max(cores, int(session.conf.get("spark.sql.shuffle.partitions")))
    if rows is not None:
        wanted = min(wanted, cores * max(2, math.ceil(rows / ROWS_PER_TASK / cores)))
    return df.repartition(wanted)


def fit(
    features: DataFrame,
    model: ModelConfig,
    base_score: float,
    inputs: Sequence[str] = FEATURES,
    rows: int | None = None,
) -> RatingModel:
    """Fit on the inputs (all 22) and ``stars``; only the trees reach the driver.

    ``base_score`` is the global mean, from which the first tree starts. The training rows are kept
    on disk after they are spread, because the regressor plans its input twice and scans it three
    times; memory is left to the compact copy that it makes and scans once per level of a tree.
    ``rows`` is about their number, if that is known.
    """
    ensure_checkpoint_dir(features.sparkSession)
    train = training_set(features, base_score, inputs=inputs)
    spread = on_all_cores(train, rows).persist(StorageLevel.DISK_ONLY)
    try:
        return RatingModel(estimator(model).fit(spread), base_score, inputs)
    finally:
        spread.unpersist()
