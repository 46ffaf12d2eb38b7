"""RMSE and absolute-error histogram of predictions against held-out ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lower edges of the error bins; the last one is open.
ERROR_BINS = (0, 1, 2, 3, 4)


def evaluate(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row: n, rmse and the counts bin_0 ... bin_4, in a single pass.

    ``truth`` has (user, item, stars), ``predictions`` (user, item, prediction). Duplicates of a
    pair are reduced to the highest value first; truth without a prediction is left out.
    """
    expected = truth.groupBy("user", "item").agg(F.max("stars").alias("stars"))
    predicted = predictions.groupBy("user", "item").agg(F.max("prediction").alias("prediction"))
    err = F.abs(F.col("prediction") - F.col("stars"))
    bins = [
        F.count_if((err >= low) & (err < low + 1 if low < ERROR_BINS[-1] else F.lit(True))).alias(f"bin_{low}")
        for low in ERROR_BINS
    ]
    return expected.join(predicted, ["user", "item"]).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(err * err)).alias("rmse"), *bins
    )


def error_bins(evaluation: DataFrame) -> DataFrame:
    """The histogram as rows (bin, n), empty bins included."""
    rows = F.array(
        *[F.struct(F.lit(b).cast("bigint").alias("bin"), F.col(f"bin_{b}").alias("n")) for b in ERROR_BINS]
    )
    return evaluation.select(F.explode(rows).alias("r")).select("r.bin", "r.n")
