"""Where a loop's plan is cut: a checkpoint in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where the setting is missing, a local master gets a temporary one; on a cluster,
    whose executors would not see that, it is an error."""
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder, and read from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
