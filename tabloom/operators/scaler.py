"""Scaling to z-scores, or to [-1, 1] for columns with extreme z-scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import by_name, replace_columns
from ..functions.selection import medians, profile
from ..sources.stats import ColumnStats

EXTREME_Z = 5.0


def scaler_fit(df: DataFrame, cols: Sequence[str], middle: dict[str, float | None] | None = None) -> ColumnStats:
    """Type, median, mean, std (n-1), max, min per column, by one wide aggregate and one pass for the exact medians.

    `minmax` if any |z| > 5, `constant` for a single value, else `normal`. Known medians may be given as `middle`.
    """
    cols = list(cols)
    if middle is None:
        known = profile(df, {c: by_name(c) for c in cols})
        per = {c: (known.count[c], known.mean[c], known.std[c], known.high[c], known.low[c]) for c in cols}
        middle, _ = medians(df, {c: by_name(c) for c in cols}, known.count, known.grids)
    else:
        row = df.agg(*[f(by_name(c)) for c in cols for f in (F.count, F.avg, F.stddev_samp, F.max, F.min)]).first()
        per = {c: row[5 * i : 5 * i + 5] for i, c in enumerate(cols)}
    stats = ColumnStats("scaler")
    for c in cols:
        count, mean, std, high, low = per[c]
        if count and high == low:
            std = 0.0
        kind = "normal"
        if std == 0.0:
            kind = "constant"
        elif std and ((high - mean) / std > EXTREME_Z or (low - mean) / std < -EXTREME_Z):
            kind = "minmax"
        stats.columns[c] = {
            "scaling_type": kind,
            "median": middle.get(c),
            "mean": mean,
            "std": std,
            "max": high,
            "min": low,
        }
    return stats


def _scaled(c: str, s: dict):
    if s["std"] is None:  # nothing observed
        return by_name(c)
    if s["std"] == 0.0:
        return F.lit(0.0)
    if s["scaling_type"] == "minmax":
        return (F.lit(2.0) * by_name(c) - F.lit(s["max"] + s["min"])) / F.lit(s["max"] - s["min"])
    return (by_name(c) - F.lit(s["mean"])) / F.lit(s["std"])


def scaler_transform(df: DataFrame, stats: ColumnStats, cols: Sequence[str] = ()) -> DataFrame:
    """(x - mean)/std or (2x - (max + min))/(max - min); a constant column becomes 0.0 throughout."""
    return replace_columns(df, {c: _scaled(c, stats.columns[c]) for c in cols or stats.columns if c in df.columns})


def scaler_fit_transform(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, ColumnStats]:
    stats = scaler_fit(df, cols)
    return scaler_transform(df, stats, cols), stats


def scaled_median(s: dict) -> float | None:
    """Median of the scaled column; scaling keeps the order, so no second pass is needed."""
    if s["median"] is None or s["std"] is None:
        return None
    if s["std"] == 0.0:
        return 0.0
    if s["scaling_type"] == "minmax":
        return (2.0 * s["median"] - (s["max"] + s["min"])) / (s["max"] - s["min"])
    return (s["median"] - s["mean"]) / s["std"]


def scaler_back(df: DataFrame, stats: ColumnStats, cols: Sequence[str] = ()) -> DataFrame:
    changed = {}
    for c in cols or stats.columns:
        s = stats.columns.get(c)
        if s is None or c not in df.columns or s["std"] is None:
            continue
        if s["scaling_type"] == "minmax":
            changed[c] = F.lit(0.5) * (by_name(c) * F.lit(s["max"] - s["min"]) + F.lit(s["max"] + s["min"]))
        else:
            changed[c] = by_name(c) * F.lit(s["std"]) + F.lit(s["mean"])
    return replace_columns(df, changed)
