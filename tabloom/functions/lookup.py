"""Left lookups that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .columns import by_name
BROADCAST_ROWS = 100_000
HOT_KEYS = 1_000


def lookup(df: DataFrame, table: DataFrame, keys: list[str], weight: str, table_rows: int | None = None) -> DataFrame:
    """`df` left join `table` on `keys`; `table` has one row per key and the key's row count in `weight`.

    A table of at most BROADCAST_ROWS rows is broadcast. Beyond that, keys that hold
    more than 1/HOT_KEYS of all weight (so fewer than HOT_KEYS of them) are broadcast
    and the remaining, necessarily light keys go through a shuffle join.
    """
    table_rows = table.count() if table_rows is None else table_rows
    values = [c for c in table.columns if c not in keys and c != weight]
    if table_rows <= BROADCAST_ROWS:
        return df.join(F.broadcast(table.drop(weight)), keys, "left").select(*map(by_name, df.columns), *values)
    total = table.agg(F.sum(weight)).first()[0]
    is_hot = by_name(weight) * HOT_KEYS > F.lit(total)
    hot = table.where(is_hot).drop(weight).withColumn("__hot", F.lit(True))
    cold = table.where(~is_hot).drop(weight)
    marked = df.join(F.broadcast(hot), keys, "left")
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | by_name(k).isNull()
    hot_rows = marked.where(F.col("__hot") | null_key).select(*map(by_name, df.columns), *values)
    cold_rows = marked.where(F.col("__hot").isNull() & ~null_key).select(*map(by_name, df.columns)).join(cold, keys, "left")
    return hot_rows.unionByName(cold_rows.select(*map(by_name, df.columns), *values))
