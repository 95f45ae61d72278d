"""Fitted column statistics: a small value object and its table form on disk."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "pos int, kind string, col string, stat string, value string"


@dataclass
class ColumnStats:
    """`columns` maps column name to its statistics, in fit order."""

    kind: str
    columns: dict[str, dict] = field(default_factory=dict)

    def updated(self, other: "ColumnStats") -> "ColumnStats":
        """These statistics with those of `other` added or replaced (a refit of some columns)."""
        return ColumnStats(self.kind, {**self.columns, **other.columns})


def stats_frame(spark: SparkSession, stats: ColumnStats) -> DataFrame:
    """One row per (column, statistic); values are JSON text so numbers survive exactly."""
    rows = [
        (pos, stats.kind, col, stat, json.dumps(value))
        for pos, (col, values) in enumerate(stats.columns.items())
        for stat, value in (values or {"": None}).items()
    ]
    return spark.createDataFrame(rows, SCHEMA)


def save_stats(spark: SparkSession, stats: ColumnStats, path: str) -> None:
    stats_frame(spark, stats).coalesce(1).write.mode("overwrite").json(path)


def load_stats(spark: SparkSession, path: str) -> ColumnStats:
    # a few rows per table column, written by save_stats
    rows = spark.read.schema(SCHEMA).json(path).orderBy("pos").collect()
    out = ColumnStats(rows[0]["kind"] if rows else "")
    for r in rows:
        values = out.columns.setdefault(r["col"], {})
        if r["stat"]:
            values[r["stat"]] = json.loads(r["value"])
    return out
