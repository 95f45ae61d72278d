"""Replacement of missing numbers: median, zero, random observed value, model prediction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import by_name, replace_columns
from ..functions.order import ordered
from ..functions.rng import uniform
from ..functions.selection import medians, profile
from .boosting import fit_boosted

# fixed parameters of the boosted trees and the marker they see for a missing feature
SENTINEL = -9999.0
BOOSTING = {"maxIter": 200, "maxDepth": 5, "stepSize": 0.01, "minInstancesPerNode": 30}


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    known = profile(df, {c: by_name(c) for c in cols})
    middle, _ = medians(df, {c: by_name(c) for c in cols}, known.count, known.grids)
    return impute_values(df, {c: m for c, m in middle.items() if m is not None})


def impute_values(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return replace_columns(df, {c: F.coalesce(by_name(c), F.lit(float(v))) for c, v in values.items()})


def impute_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return impute_values(df, {c: 0.0 for c in cols})


def impute_random(df: DataFrame, cols: Sequence[str], key: str, seed=0) -> DataFrame:
    """NULL becomes a draw with replacement from the column's observed values.

    One global order numbers the observed values of all columns; a missing cell asks
    for a random number of its column. Requests and values meet in an equi-join on
    (column, number), which is balanced because each number occurs once.
    """
    cols = list(cols)
    seen = {c: F.when(by_name(c).isNotNull(), 1).otherwise(0) for c in cols}
    counted = ordered(df.select(by_name(key), *map(by_name, cols)), [key], {f"__n_{c}": seen[c] for c in cols})
    observed = {c: int(counted.totals[f"__n_{c}"]) for c in cols}
    cells = [
        F.struct(
            F.lit(c).alias("col"),
            by_name(c).cast("double").alias("value"),
            F.when(by_name(c).isNotNull(), by_name(f"__n_{c}") - 1)
            .otherwise(F.floor(uniform(seed, c, key) * F.lit(float(observed[c]))))
            .cast("bigint")
            .alias("number"),
        )
        for c in cols
        if observed[c] > 0
    ]
    if not cells:
        return df
    # every column of a row needs a cell only where it is observed or asks
    long = counted.df.select(by_name(key), F.explode(F.array(*cells)).alias("cell")).select(by_name(key), "cell.*")
    values = long.where(F.col("value").isNotNull()).select("col", "number", "value")
    wanted = long.where(F.col("value").isNull()).select(by_name(key), "col", "number")
    drawn = wanted.join(values, ["col", "number"])
    filled = drawn.groupBy(by_name(key)).agg(*[F.max(F.when(F.col("col") == c, F.col("value"))).alias(f"__f_{c}") for c in cols])
    joined = df.join(filled, key, "left")
    return replace_columns(
        joined, {c: F.coalesce(by_name(c), by_name(f"__f_{c}")) for c in cols}, {f"__f_{c}" for c in cols}
    )


def impute_model(df: DataFrame, cols: Sequence[str], features: Sequence[str], **boosting) -> DataFrame:
    """Boosted trees per column on the other features; only NULL rows are predicted.

    All models are trained on the table as given, with missing features at the sentinel.
    Predictions run column by column, so later columns see earlier fills. `boosting` changes the
    parameters of `fit_boosted`.
    """
    features = list(features)
    wanted = [c for c, n in zip(cols, df.agg(*[F.count_if(by_name(c).isNull()) for c in cols]).first()) if n]
    if not wanted:
        return df
    known = profile(df, {f: by_name(f) for f in features})
    models = {c: fit_boosted(df, c, [f for f in features if f != c], missing=SENTINEL, known=known, **{**BOOSTING, **boosting}) for c in wanted}
    work = df
    for c in wanted:
        work = replace_columns(work, {c: F.coalesce(by_name(c), models[c].predict(by_name(c).isNull(), SENTINEL))})
    return work
