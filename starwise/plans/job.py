"""spark-submit entry: ``job.py <folder> <requests file> <output folder name> [ratings file]``."""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from starwise.config import Config
from starwise.operators.evaluate import evaluate
from starwise.operators.stats import dedupe_ratings
from starwise.plans.predict import end_to_end
from starwise.runtime import written
from starwise.sources import profiles, ratings


@dataclass(frozen=True)
class JobPaths:
    """File names below the job's folder. ``train_file`` names the file of ratings."""

    folder: str
    requests_file: str
    output_name: str
    train_file: str = "train.csv"

    @property
    def train(self) -> str:
        return f"{self.folder}/data/{self.train_file}"

    @property
    def requests(self) -> str:
        return f"{self.folder}/data/{self.requests_file}"

    @property
    def users(self) -> str:
        return f"{self.folder}/data/user.json"

    @property
    def items(self) -> str:
        return f"{self.folder}/data/business.json"

    @property
    def output(self) -> str:
        return f"{self.folder}/output/{self.output_name}"


def run_job(
    spark: SparkSession, paths: JobPaths, config: Config | None = None, left_out: dict[str, int] | None = None
) -> DataFrame:
    """Read the files, predict every request, write the predictions and return them as written.

    The written rows follow the order of the requests; there are as many of them. ``left_out`` is
    filled with the number of lines per file that could not be read, counted as they are read.
    """
    seen = {name: Observation(f"left out of {name}") for name in ("ratings", "users", "items")}
    lines = {name: profiles.read_json_lines(spark, path) for name, path in (("users", paths.users), ("items", paths.items))}
    predictions = end_to_end(
        written(ratings.read_requests(spark, paths.requests, "position")),
        written(dedupe_ratings(ratings.read_ratings(spark, paths.train, seen["ratings"]))),
        profiles.user_features(profiles.observed(lines["users"], seen["users"])),
        profiles.item_features(profiles.observed(lines["items"], seen["items"])),
        config or Config(),
    )
    ratings.write_predictions(predictions, paths.output, "position")
    if left_out is not None:
        left_out.update({name: found.get["left_out"] for name, found in seen.items()})
    return ratings.read_predictions(spark, paths.output)


def count_left_out(spark: SparkSession, paths: JobPaths) -> dict[str, int]:
    """Lines of the input files that could not be read, by file."""
    return {
        "ratings": ratings.count_unreadable(spark, paths.train),
        "users": profiles.count_unreadable(profiles.read_json_lines(spark, paths.users)).first().unreadable,
        "items": profiles.count_unreadable(profiles.read_json_lines(spark, paths.items)).first().unreadable,
    }


def evaluate_files(spark: SparkSession, truth_path: str, prediction_path: str) -> DataFrame:
    """RMSE and error histogram of written predictions against a file of ratings."""
    truth = ratings.read_ratings(spark, truth_path)
    return evaluate(truth, ratings.read_predictions(spark, prediction_path))


if __name__ == "__main__":
    run_job(SparkSession.builder.appName("starwise").getOrCreate(), JobPaths(*sys.argv[1:5]))
