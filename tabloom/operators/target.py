"""Centring of 0/1 targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import by_name, replace_columns


def center_target(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    return replace_columns(df, {c: by_name(c) - F.lit(0.5) for c in targets})


def uncenter_target(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """y + 0.5 truncated to int."""
    return replace_columns(df, {c: (by_name(c) + F.lit(0.5)).cast("int") for c in targets})
