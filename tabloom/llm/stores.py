"""Tables written once in the folder that all executors share, to cut a plan in two."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..functions.materialize import ensure_checkpoint_dir


def stored(df: DataFrame) -> DataFrame:
    """`df`, written as Parquet below ``spark.checkpoint.dir`` and read again.

    A lost executor loses nothing of it, and unlike a checkpoint it is columnar. The folder's owner removes old tables.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = f"{folder}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
