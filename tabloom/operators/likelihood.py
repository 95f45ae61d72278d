"""Smoothed-likelihood encoding: a category becomes its shrunken mean target."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import by_name, replace_columns
from ..functions.lookup import lookup
from ..functions.materialize import materialize

PRIOR_ROWS = 30.0  # weight of the global average


@dataclass
class LikelihoodStats:
    """`table` has (col, value, sum, count, smoothed_mean); it stays distributed, vocabularies may be large."""

    global_avg: float
    table: DataFrame
    values: dict[str, int]  # rows of the table per column


def laplace_fit(df: DataFrame, target: str, cols: Sequence[str]) -> LikelihoodStats:
    """(sum + 30*avg) / (count + 30) per category; NULL categories have no row."""
    cols = list(cols)
    global_avg = df.agg(F.avg(by_name(target))).first()[0]
    long = df.select(by_name(target).cast("double").alias("__y"), *[by_name(c).cast("string").alias(c) for c in cols])
    long = long.unpivot(["__y"], [by_name(c) for c in cols], "col", "value").where(F.col("value").isNotNull())
    table = long.groupBy("col", "value").agg(F.sum("__y").alias("sum"), F.count("*").alias("count"))
    mean = (F.coalesce("sum", F.lit(0.0)) + F.lit(None if global_avg is None else PRIOR_ROWS * global_avg)) / (F.col("count") + F.lit(PRIOR_ROWS))
    table = materialize(table.withColumn("smoothed_mean", mean))
    sizes = {r["col"]: r["n"] for r in table.groupBy("col").agg(F.count("*").alias("n")).collect()}
    return LikelihoodStats(global_avg, table, {c: sizes.get(c, 0) for c in cols})


def laplace_transform(df: DataFrame, stats: LikelihoodStats, cols: Sequence[str], replace: bool = True) -> DataFrame:
    """Left lookup of each column; no match gives the global average; columns without statistics are skipped."""
    out = df
    for c in cols:
        if c not in stats.values:
            continue
        table = stats.table.where(F.col("col") == c).select(
            F.col("value").alias("__value"), F.col("smoothed_mean").alias("__likelihood"), F.col("count").alias("__n")
        )
        out = out.withColumn("__value", by_name(c).cast("string"))
        out = lookup(out, table, ["__value"], "__n", stats.values[c])
        encoded = F.coalesce("__likelihood", F.lit(stats.global_avg))
        out = replace_columns(out, {c if replace else f"{c}_likeli": encoded}, {"__value", "__likelihood"})
    return out


def laplace_fit_transform(
    df: DataFrame, target: str, cols: Sequence[str], replace: bool = True
) -> tuple[DataFrame, LikelihoodStats]:
    stats = laplace_fit(df, target, cols)
    return laplace_transform(df, stats, cols, replace), stats


def save_likelihoods(stats: LikelihoodStats, path: str) -> None:
    stats.table.withColumn("global_avg", F.lit(stats.global_avg)).write.mode("overwrite").parquet(path)


def load_likelihoods(spark: SparkSession, path: str) -> LikelihoodStats:
    table = spark.read.parquet(path)
    per_column = table.groupBy("col").agg(F.count("*").alias("n"), F.first("global_avg").alias("avg")).collect()
    return LikelihoodStats(
        per_column[0]["avg"] if per_column else None,
        table.drop("global_avg"),
        {r["col"]: r["n"] for r in per_column},
    )
