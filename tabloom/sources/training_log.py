"""Training logs, checkpoint names and the choice of the best checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import by_name
# fixed formats of the log line and of the checkpoint file name
ITER_PATTERN = r"Iter:\s(.*?);"
G_LOSS_PATTERN = r"G loss:\s(.*?);"
D_LOSS_PATTERN = r"D loss:\s(.*?);"
SIMILARITY_PATTERN = r"similarity:\s(.*?)$"
CHECKPOINT_PATTERN = r"check_point_([0-9]+)\.ckpt\.meta$"


def parse_training_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """Text lines to (iter, G_loss, D_loss, similarity); a part that is not in the line is NULL."""

    def number(pattern: str):
        text = F.regexp_extract(by_name(line), pattern, 1)
        return F.when(text != "", text.try_cast("double"))

    return lines.select(
        number(ITER_PATTERN).cast("bigint").alias("iter"),
        number(G_LOSS_PATTERN).alias("G_loss"),
        number(D_LOSS_PATTERN).alias("D_loss"),
        number(SIMILARITY_PATTERN).alias("similarity"),
    )


def read_training_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_training_log(spark.read.text(path))


def checkpoint_iterations(names: DataFrame, name: str = "path") -> DataFrame:
    """File names to checkpoint iterations; other files are left out."""
    text = F.regexp_extract(by_name(name), CHECKPOINT_PATTERN, 1)
    return names.where(text != "").select(text.cast("bigint").alias("iter"))


def list_checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    """Iterations saved in a folder; only file names are read, not their content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "check_point_*.ckpt.meta").load(folder)
    return checkpoint_iterations(files.select("path"))


def best_checkpoint(log: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """The saved iteration with the lowest similarity; unknown similarity ranks last, ties by iteration."""
    return log.join(checkpoints, "iter").orderBy(F.asc_nulls_last("similarity"), "iter").limit(1)


def loss_trace(losses: DataFrame, every: int, iteration: str = "iter") -> DataFrame:
    """Mean of each loss column over consecutive blocks of `every` iterations."""
    block = F.floor((by_name(iteration) - 1) / every).cast("bigint")
    values = [c for c in losses.columns if c != iteration]
    return losses.groupBy(block.alias("block")).agg(*[F.avg(by_name(c)).alias(c) for c in values])
