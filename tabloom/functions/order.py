"""Global row numbers and running sums without pulling the table into one task.

`orderBy` range-partitions and sorts; `monotonically_increasing_id` then holds
(partition, position) for every row. The placed rows are checkpointed, because
range bounds are sampled and would differ if the plan were computed twice. Running sums
are taken while the sorted partitions pass, so they cost no further shuffle. Only
one row per partition (counts and sums) reaches the driver.

Order keys must be unique, otherwise the rank of tied rows is arbitrary.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .columns import by_name
from .materialize import materialize

_PLACE = "__place"
_PART = "__part"
_POSITION_BITS = 33  # layout of monotonically_increasing_id


@dataclass
class Ordered:
    """Rows with their global order; `rows` and `totals` are exact table totals."""

    df: DataFrame
    rows: int
    totals: dict[str, float]


def _summed(width: int):
    """Appends the running sums of the last `width` columns of a partition; NULL adds nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = np.zeros(width)
        for b in batches:
            added = []
            for i in range(width):
                column = b.column(b.num_columns - width + i).fill_null(0.0).to_numpy(zero_copy_only=False)
                # in the order of the rows, as one sum would go
                sums = np.cumsum(np.append(before[i], column))[1:]
                before[i] = sums[-1] if len(sums) else before[i]
                added.append(pa.array(sums))
            yield pa.RecordBatch.from_arrays([*b.columns, *added], names=[*b.schema.names, *[f"__run{i}" for i in range(width)]])

    return run


def _place(df: DataFrame, order: Sequence[Column | str], sums: Sequence[Column]) -> DataFrame:
    placed = df.orderBy(*map(by_name, order))
    if sums:
        placed = placed.select("*", *[v.cast("double").alias(f"__sum_of{i}") for i, v in enumerate(sums)])
        names = [*placed.columns, *[f"__run{i}" for i in range(len(sums))]]
        plain = placed.toDF(*[f"c{i}" for i in range(len(placed.columns))])  # Python functions refuse some characters in names
        fields = [*plain.schema.fields, *[StructField(f"__run{i}", DoubleType()) for i in range(len(sums))]]
        placed = plain.mapInArrow(_summed(len(sums)), StructType(fields)).toDF(*names)
    return materialize(placed.withColumn(_PLACE, F.monotonically_increasing_id())).withColumn(_PART, F.shiftright(_PLACE, _POSITION_BITS))


def ordered(
    df: DataFrame,
    order: Sequence[Column | str],
    sums: Mapping[str, Column | str] | None = None,
    index: str = "row_no",
) -> Ordered:
    """Add `index` (1-based global rank by `order`) and one running sum per entry of `sums`."""
    sums = {k: (by_name(v) if isinstance(v, str) else v) for k, v in (sums or {}).items()}
    names = list(sums)
    placed = _place(df, order, list(sums.values()))
    per_part = (
        placed.groupBy(_PART)
        .agg(F.count("*").alias("n"), *[F.sum(f"__sum_of{i}").alias(f"s{i}") for i in range(len(names))])
        .collect()
    )
    rows, running = 0, [0] * len(names)
    offsets = []
    for part in sorted(per_part, key=lambda r: r[0]):
        offsets.append((part[0], rows, *[float(v) for v in running]))
        rows += part[1]
        running = [a + (b or 0) for a, b in zip(running, part[2:])]
    schema = f"{_PART} bigint, __rows bigint" + "".join(f", __sum{i} double" for i in range(len(names)))
    starts = df.sparkSession.createDataFrame(offsets, schema)

    # `starts` has one row per partition
    out = placed.join(F.broadcast(starts), _PART)
    position = by_name(_PLACE).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    out = out.select(
        *map(by_name, df.columns),
        (F.col("__rows") + position + 1).alias(index),
        *[(by_name(f"__sum{i}") + by_name(f"__run{i}")).alias(s) for i, s in enumerate(names)],
    )
    return Ordered(out, rows, dict(zip(names, running)))


def row_index(df: DataFrame, order: Sequence[Column | str], index: str = "row_no") -> DataFrame:
    return ordered(df, order, index=index).df
