"""The folder that the driver and all executors share."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names. Only a local session may do without one: what a cluster's driver has in a
    folder of its own, its executors don't see."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("name a shared folder in spark.checkpoint.dir")
    return os.path.join(tempfile.gettempdir(), "moothall-checkpoints")


def put_aside(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder(df.sparkSession))
    return df.checkpoint(eager=True)
