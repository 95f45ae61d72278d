"""One-hot encoding with values -0.5 and +0.5, and its inverse.

A fitted encoding has one column per value, so it is for few values. Columns of many values keep their
vocabulary as a table: `onehot_vocabulary`, and per row the position of the one value that is on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import by_name, replace_columns
from ..functions.lookup import lookup
from ..functions.order import ordered
from ..sources.stats import ColumnStats

NULL_CATEGORY = "null"
MAX_VALUES = 10_000  # per column of a fitted encoding: each becomes a column of the table


def _category(col: str):
    return F.coalesce(by_name(col).cast("string"), F.lit(NULL_CATEGORY))


def onehot_fit(df: DataFrame, cols: Sequence[str], order: str, max_values: int = MAX_VALUES) -> ColumnStats:
    """Distinct values per column in first-seen order (by `order`), NULL as 'null'.

    A column whose values are all '0' or '1' is an `indicator`, any other `categorical`.
    A column with more than `max_values` of them is refused.
    """
    cols = list(cols)
    if not cols:
        return ColumnStats("onehot")
    long = df.select(by_name(order).alias("__order"), *[_category(c).alias(c) for c in cols]).unpivot(
        ["__order"], [by_name(c) for c in cols], "col", "value"
    )
    seen = long.groupBy("col", "value").agg(F.min("__order").alias("first"))
    rows = seen.limit(len(cols) * max_values + 1).collect()
    found: dict[str, list] = {c: [] for c in cols}
    for r in sorted(rows, key=lambda r: (r["first"], r["value"])):
        found[r["col"]].append(r["value"])
    most = max(cols, key=lambda c: len(found[c]))
    if len(found[most]) > max_values:
        raise ValueError(f"column {most} has more than {max_values} values; use onehot_vocabulary, likelihood encoding or raise max_values")
    return ColumnStats(
        "onehot",
        {
            c: {"values": found[c], "type": "indicator" if set(found[c]) <= {"0", "1"} else "categorical"}
            for c in cols
        },
    )


def onehot_columns(stats: ColumnStats, drop_first: bool = False) -> list[str]:
    """Names of the encoded columns: value columns per categorical column, then the indicators."""
    out = []
    for c, s in stats.columns.items():
        if s["type"] == "categorical":
            out += [f"{c}_{v}" for v in sorted(s["values"])[1 if drop_first else 0 :]]
    return out + [c for c, s in stats.columns.items() if s["type"] == "indicator"]


def onehot_transform(
    df: DataFrame, stats: ColumnStats, remove_original: bool = True, drop_first: bool = False
) -> tuple[DataFrame, list[str]]:
    """Apply a vocabulary: a value outside it gives -0.5 everywhere; returns the encoded column names too."""
    changed, drop = {}, set()
    for c, s in stats.columns.items():
        if s["type"] == "indicator":
            changed[c] = by_name(c).cast("double") - F.lit(0.5)
    for c, s in stats.columns.items():
        if s["type"] == "categorical":
            for v in sorted(s["values"])[1 if drop_first else 0 :]:
                changed[f"{c}_{v}"] = F.when(_category(c) == F.lit(v), F.lit(0.5)).otherwise(F.lit(-0.5))
            if remove_original:
                drop.add(c)
            else:
                changed[c] = _category(c)
    return replace_columns(df, changed, drop), onehot_columns(stats, drop_first)


def onehot_fit_transform(
    df: DataFrame, cols: Sequence[str], order: str, remove_original: bool = True, drop_first: bool = False
) -> tuple[DataFrame, list[str], ColumnStats]:
    stats = onehot_fit(df, cols, order)
    out, names = onehot_transform(df, stats, remove_original, drop_first)
    return out, names, stats


def onehot_back(
    df: DataFrame,
    stats: ColumnStats,
    cols: Sequence[str] = (),
    restore_indicators: bool = False,
    drop_first: bool = False,
) -> DataFrame:
    """Value of the largest encoded column, the first in vocabulary order on ties; 'null' becomes ''.

    Indicators stay at -0.5/+0.5 unless `restore_indicators` asks for '0'/'1'.
    """
    if drop_first:
        raise ValueError("an encoding without its first value cannot be inverted")
    changed, drop = {}, set()
    for c in cols or stats.columns:
        s = stats.columns[c]
        if s["type"] == "indicator":
            if restore_indicators and c in df.columns:
                changed[c] = F.when(by_name(c) > 0, F.lit("1")).otherwise(F.lit("0"))
            continue
        present = [v for v in s["values"] if f"{c}_{v}" in df.columns]
        encoded = F.array(*[by_name(f"{c}_{v}") for v in present])
        names = F.array(*[F.lit("" if v == NULL_CATEGORY else v) for v in present])
        changed[c] = F.element_at(names, F.array_position(encoded, F.array_max(encoded)).cast("int"))
        drop |= {f"{c}_{v}" for v in present}
    return replace_columns(df, changed, drop - set(changed))


def onehot_vocabulary(df: DataFrame, cols: Sequence[str], order: str) -> DataFrame:
    """(col, value, position, n): the distinct values of each column as a table, of any length.

    Positions are 0-based in first-seen order (by `order`, equal ones by value), as in `onehot_fit`; n counts the
    value's rows. NULL is 'null'. Only one number per column reaches the driver.
    """
    long = df.select(by_name(order).alias("__order"), *[_category(c).alias(c) for c in cols]).unpivot(
        ["__order"], [by_name(c) for c in cols], "col", "value"
    )
    seen = long.groupBy("col", "value").agg(F.min("__order").alias("first"), F.count("*").alias("n"))
    placed = ordered(seen, ["col", "first", "value"]).df
    starts = placed.groupBy("col").agg(F.min("row_no").alias("start"))  # one row per column
    return placed.join(F.broadcast(starts), "col").select("col", "value", (F.col("row_no") - F.col("start")).alias("position"), "n")


def _entries(vocabulary: DataFrame, col: str) -> DataFrame:
    return vocabulary.where(F.col("col") == F.lit(col))


def onehot_index(df: DataFrame, vocabulary: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace each column by `<col>_index`, the position of its value; NULL for a value outside the vocabulary.

    This is the one-hot row in sparse form: all values are off but the one at the position.
    """
    taken = [f"{c}_index" for c in cols if f"{c}_index" in df.columns]
    if taken:
        raise ValueError(f"the table has a column {taken[0]} already")
    for c in cols:
        entries = _entries(vocabulary, c).select(F.col("value").alias("__value"), F.col("position").alias("__position"), F.col("n").alias("__n"))
        found = lookup(df.withColumn("__value", _category(c)), entries, ["__value"], "__n")
        df = found.select(*[by_name(k) for k in df.columns if k != c], F.col("__position").alias(f"{c}_index"))
    return df


def onehot_index_back(df: DataFrame, vocabulary: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values of `<col>_index` columns; 'null' becomes '', as in `onehot_back`, and no position stays NULL."""
    for c in cols:
        value = F.when(F.col("value") == NULL_CATEGORY, "").otherwise(F.col("value"))
        entries = _entries(vocabulary, c).select(F.col("position").alias("__position"), value.alias("__value"), F.col("n").alias("__n"))
        found = lookup(df.withColumn("__position", by_name(f"{c}_index")), entries, ["__position"], "__n")
        df = found.select(*[by_name(k) for k in df.columns if k != f"{c}_index"], F.col("__value").alias(c))
    return df
