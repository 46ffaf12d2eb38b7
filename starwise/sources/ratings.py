"""CSV readers for ratings, requests and predictions, and the prediction writer.

Schemas are positional and explicit, nothing is inferred. Ratings without a readable number of
stars are left out, and ``count_unreadable`` tells how many; requests are never left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starwise.operators.prefix import block_starts
from starwise.runtime import written

RATING_SCHEMA = "user STRING, item STRING, stars DOUBLE"
# Column names of the prediction file.
PREDICTION_COLUMNS = ("user_id", "business_id", "prediction")


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RATING_SCHEMA).csv(path, header=True, mode="PERMISSIVE")


def _missing() -> Column:
    return F.col("user").isNull() | F.col("item").isNull() | F.col("stars").isNull()


def read_ratings(spark: SparkSession, path: str, seen: Observation | None = None) -> DataFrame:
    """(user, item, stars) from a CSV file with a header.

    ``seen`` gets ``lines`` and ``left_out`` from the first action that reads all rows, with no
    second scan. A task that is repeated after its executor was lost may count its lines again.
    """
    rows = _read(spark, path)
    if seen is not None:
        rows = rows.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(_missing()).alias("left_out"))
    return rows.dropna(how="any")


# Where a line lies: the number of its file by name, its block of the file, and the order within the
# block. Blocks of one file may be read in any order, and numbers ascend within each.
_PLACE = ("file", "block", "line")


def read_placed(spark: SparkSession, path: str) -> DataFrame:
    """(user, item, stars) of every line, with ``place``, which ascends by file name and in a file.

    Lines that ``read_ratings`` leaves out are left out here too. Files are listed, not read, and
    numbered on the driver, which knows their names in any case; so no row is shuffled with a name.
    """
    listed = spark.read.format("binaryFile").load(path).select("_metadata.file_path").collect()
    numbered = [(name, n) for n, name in enumerate(sorted(row.file_path for row in listed))]
    files = spark.createDataFrame(numbered, "_name string, _file bigint")
    placed = _read(spark, path).select(
        "user",
        "item",
        "stars",
        F.col("_metadata.file_path").alias("_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ).dropna(subset=["user", "item", "stars"])
    known = F.expr("coalesce(_file, raise_error('a file came after the files were listed: ' || _name))")
    place = F.struct(known.cast("bigint").alias("file"), "block", "line")
    return placed.join(F.broadcast(files), "_name", "left").select("user", "item", "stars", place.alias("place"))


def dedupe_last(placed: DataFrame) -> DataFrame:
    """One rating per (user, item): that of the last line, by file name and position in the file.

    The place becomes one number, of the file's, block's and line's digits (a task numbers fewer than
    2**33 lines): values of fixed width are kept per pair, where a structure would sort all lines.
    """
    line = f"cast(place.line & {(1 << 33) - 1}L AS DECIMAL(10))"
    block = f"cast(place.block AS DECIMAL(16)) * {10**10}BD"
    at = F.expr(f"cast(cast(place.file AS DECIMAL(10)) * {10**26}BD + {block} + {line} AS DECIMAL(38))")
    return placed.groupBy("user", "item").agg(F.max_by("stars", at).alias("stars"))


def with_positions(placed: DataFrame, position: str = "position") -> DataFrame:
    """The rows numbered 0, 1, 2 ... in the order of their files, in the column ``position``.

    Lines are numbered within a block of a file, and a block starts where those before it end. Blocks
    are sorted by range; lines are added up within each range, and the ranges' sums in levels, so no
    task sees more than the lines of one block or the blocks of one range.
    """
    rows = placed.select("*", *[F.col(f"place.{name}").alias(f"_{name}") for name in _PLACE])
    blocks = rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("size"))
    number = F.monotonically_increasing_id().alias("number")
    ranged = written(blocks.orderBy("_file", "_block").select("*", F.spark_partition_id().alias("range"), number))
    ranges = ranged.agg(F.coalesce(F.max("range"), F.lit(-1))).first()[0] + 1
    starts = block_starts(ranged.groupBy("range").agg(F.sum("size").alias("size")), ranges, "range", "size")
    before = Window.partitionBy("range").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    at = ranged.select("_file", "_block", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_before")).join(starts, "range")
    inside = F.row_number().over(Window.partitionBy("_file", "_block").orderBy("_line"))
    found = rows.withColumn("_inside", inside).join(at, ["_file", "_block"])
    place = F.col("start") + F.col("_before") + F.col("_inside") - 1
    return found.select(*placed.columns, place.cast("bigint").alias(position))


def count_unreadable(spark: SparkSession, path: str) -> int:
    """Rows that ``read_ratings`` leaves out: too short, or without a number of stars."""
    return _read(spark, path).where(_missing()).count()


def read_requests(spark: SparkSession, path: str, position: str | None = None) -> DataFrame:
    """(user, item) from the first two columns of a CSV file with a header, every row of it.

    A missing or empty id is an empty text. With ``position`` a column of that name ascends in
    the order of the file.
    """
    rows = _read(spark, path).select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("user", "item")])
    return rows if position is None else rows.withColumn(position, F.monotonically_increasing_id())


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """(user, item, prediction) as written by ``write_predictions``."""
    rows = _read(spark, path).where(F.col("stars").isNotNull()).withColumnRenamed("stars", "prediction")
    return rows.fillna("", ["user", "item"])


def write_predictions(predictions: DataFrame, path: str, position: str | None = None) -> None:
    """Folder of CSV files with a header each, written in parallel by all tasks.

    With ``position`` the files and the rows in them follow that column, which is not written.
    """
    if position is not None:
        predictions = predictions.orderBy(position)
    named = predictions.select(
        *[F.col(c).alias(name) for c, name in zip(("user", "item", "prediction"), PREDICTION_COLUMNS)]
    )
    named.write.mode("overwrite").csv(path, header=True)
