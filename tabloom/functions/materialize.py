"""Reliable checkpoints: cut a plan without tying it to one executor's disk."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; fall back to a temp folder in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tabloom-checkpoint-")
    sc.setCheckpointDir(folder)


def materialize(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession) -> str:
    """A folder of its own, not made yet, where all executors can write."""
    ensure_checkpoint_dir(spark)
    return f"{spark.conf.get('spark.checkpoint.dir', None) or spark.sparkContext.getCheckpointDir()}/files-{uuid.uuid4().hex}"
