"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def quoted(name: str) -> str:
    """A column's name as SQL text, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def by_name(name: str | Column) -> Column:
    """The column of exactly this name; a dot in it is a character like any other."""
    return name if isinstance(name, Column) else F.col(quoted(name))


def null_double() -> Column:
    return F.lit(None).cast("double")


def not_nan(value: Column) -> Column:
    """NaN becomes NULL, the only missing marker used here."""
    return F.nanvl(value, null_double())


def clip(value: Column, low: float, high: float) -> Column:
    """Clip that leaves NULL alone (least and greatest would skip it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high))))


def replace_columns(df: DataFrame, changed: dict[str, Column], drop: set[str] | frozenset = frozenset()) -> DataFrame:
    """One projection: keep order, swap changed columns in place, append new ones, drop others."""
    kept = [
        changed[c].alias(c) if c in changed else by_name(c)
        for c in df.columns
        if c not in drop
    ]
    added = [expr.alias(c) for c, expr in changed.items() if c not in df.columns]
    return df.select(*kept, *added)
