"""What tree-dump text says about features: split ranges for capping, and gain importance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import by_name, replace_columns
from ..sources.roles import Roles
from ..sources.stats import ColumnStats

# fixed format of a split in a dump line: [f<index><<threshold>], and of its gain
SPLIT_PATTERN = r"\[f([0-9]+)<([-+]?[0-9]*\.?[0-9]+([eE][-+]?[0-9]+)?)\]"
GAIN_PATTERN = r"gain=([-+]?[0-9]*\.?[0-9]+([eE][-+]?[0-9]+)?)"


def tree_features(header: Roles) -> list[str]:
    """Feature number to column name: header columns with role N, C or G in order."""
    return header.of("N", "C", "G")


def splitcap_fit(dump: DataFrame, features: Sequence[str], columns: Sequence[str], line: str = "value") -> ColumnStats:
    """Smallest and largest threshold per feature that is among `columns`."""
    text = by_name(line)
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(SPLIT_PATTERN), 1).alias("f"),
        F.regexp_extract_all(text, F.lit(SPLIT_PATTERN), 2).alias("t"),
    )
    splits = dump.select(F.explode(pairs).alias("split")).select(
        F.col("split.f").cast("int").alias("f"), F.col("split.t").cast("double").alias("t")
    )
    ends = splits.groupBy("f").agg(F.min("t").alias("low"), F.max("t").alias("high")).where(F.col("f") < len(features))
    rows = {r["f"]: r for r in ends.collect()}  # one row per feature
    return ColumnStats(
        "splitcap",
        {
            features[f]: {"min_split": rows[f]["low"], "max_split": rows[f]["high"]}
            for f in sorted(rows)
            if features[f] in columns
        },
    )


def splitcap_transform(df: DataFrame, stats: ColumnStats, cols: Sequence[str] = ()) -> DataFrame:
    """Range to [-1, 1] with 2 and -2 beyond it; with a single threshold the sign of x - threshold."""
    changed = {}
    for c in cols or stats.columns:
        if c not in stats.columns or c not in df.columns:
            continue
        low, high = stats.columns[c]["min_split"], stats.columns[c]["max_split"]
        if high > low:
            x = (F.lit(2.0) * by_name(c) - F.lit(high + low)) / F.lit(high - low)
            changed[c] = F.when(x > 1, F.lit(2.0)).when(x < -1, F.lit(-2.0)).otherwise(x)
        else:
            x = by_name(c) - F.lit(low)
            changed[c] = F.when(x > 0, F.lit(1.0)).when(x < 0, F.lit(-1.0)).otherwise(x)
    return replace_columns(df, changed)


def splitcap_fit_transform(
    df: DataFrame, dump: DataFrame, features: Sequence[str], line: str = "value"
) -> tuple[DataFrame, ColumnStats]:
    stats = splitcap_fit(dump, features, df.columns, line)
    return splitcap_transform(df, stats), stats


def splitcap_back(df: DataFrame, stats: ColumnStats, cols: Sequence[str] = ()) -> DataFrame:
    changed = {}
    for c in cols or stats.columns:
        if c not in stats.columns or c not in df.columns:
            continue
        low, high = stats.columns[c]["min_split"], stats.columns[c]["max_split"]
        if high > low:
            changed[c] = F.lit(0.5) * (by_name(c) * F.lit(high - low) + F.lit(high + low))
        else:
            changed[c] = by_name(c) + F.lit(low)
    return replace_columns(df, changed)


def tree_importance(dump: DataFrame, features: Sequence[str], line: str = "value") -> DataFrame:
    """(feature, gain): mean gain per feature over its splits, largest first."""
    text = by_name(line)
    number = F.regexp_extract(text, SPLIT_PATTERN, 1)
    gain = F.regexp_extract(text, GAIN_PATTERN, 1)
    per = (
        dump.where((number != "") & (gain != ""))
        .groupBy(number.cast("int").alias("__f"))
        .agg(F.avg(gain.cast("double")).alias("gain"))
    )
    name = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("__f") + 1)
    return per.where(F.col("__f") < len(features)).select(name.alias("feature"), "gain").orderBy(F.desc("gain"), "feature")
