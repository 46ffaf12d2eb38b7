"""Session helpers: where checkpoints go, and cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder. On a cluster a
    machine-local folder would be lost with its executor, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="starwise-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder once and continue from there.

    Used where a result is read several times: lost executors then re-read files instead of
    recomputing a long chain of shuffles.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession) -> str:
    """A new path below the checkpoint folder, which goes when the application ends."""
    folder = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table below the checkpoint folder once and read it from there.

    Unlike a checkpoint, a table is read by column, filters are pushed down to it, and its size is
    known to the planner. It goes when the application ends.
    """
    spark, folder = df.sparkSession, scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
