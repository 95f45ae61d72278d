"""Scaled rows back to the layout of the original table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..operators.boxcox import boxcox_back
from ..operators.missing import special_back
from ..operators.onehot import onehot_back
from ..operators.scaler import scaler_back
from ..operators.splits import splitcap_back
from ..operators.target import uncenter_target
from ..sources.roles import Roles
from ..sources.stats import ColumnStats
from ..sources.tables import restore_layout


def postprocess(
    generated: DataFrame,
    header: Roles,
    stats: Mapping[str, ColumnStats],
    key: str,
    key_name: str = "unq1",
    exact_counts: bool = False,
    restore_indicators: bool = False,
    numbered: bool = False,
) -> DataFrame:
    """Undo target, scaling, Box-Cox, split capping if used, special values and one-hot; then surrogate key and header order.

    `key` identifies a generated row; it orders the surrogate keys and breaks ties. `numbered` says
    it already counts the rows from 0, which saves the sort.
    """
    table = uncenter_target(generated, header.targets[:1])
    table = scaler_back(table, stats["scaler"])
    table = boxcox_back(table, stats["boxcox"])
    if "splitcap" in stats:
        table = splitcap_back(table, stats["splitcap"])
    table = special_back(table, stats["special"], key, exact_counts=exact_counts)
    table = onehot_back(table, stats["onehot"], restore_indicators=restore_indicators)
    return restore_layout(table, header.names, [key], key_name, numbered)
