"""New rows from a generator network: noise, conditions, translation, reconstruction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import by_name, replace_columns
from ..functions.lookup import BROADCAST_ROWS
from ..functions.order import ordered
from ..functions.rng import normals, uniform
from ..functions.selection import is_numeric, order_statistics
from .network import Network, dense_forward, spread

BATCH = 5_000  # fixed: translation stops at a multiple of it
REPEATS = 1_000  # ids one row gives at once


def sample_noise(df: DataFrame, count: int, key: str, seed=0, prefix: str = "z", method: str = "md5") -> DataFrame:
    """Append `count` standard normals per row, keyed by `key`."""
    noise = normals(count, seed, "noise", key, method=method)
    return df.select("*", *[v.alias(f"{prefix}{i}") for i, v in enumerate(noise)])


def _noise_names(count: int) -> list[str]:
    return [f"__z{i}" for i in range(count)]


def generate_unconditional(
    spark: SparkSession, rows: int, net: Network, columns: Sequence[str], noise: int, seed=0, **forward
) -> DataFrame:
    """`rows` rows (id, columns) from noise alone."""
    ids = sample_noise(spread(spark.range(rows), net, "id", rows), noise, "id", seed, "__z")
    return dense_forward(ids, net, _noise_names(noise), columns, key="id", **forward).select("id", *columns)


def _pin(df: DataFrame, pinned: str | None, agg: str = "max") -> DataFrame:
    if pinned is None:
        return df
    value = df.agg({"max": F.max, "min": F.min}[agg](pinned)).first()[0]
    return replace_columns(df, {pinned: F.lit(value)})


def repeat_rows(table: DataFrame, cols: Sequence[str], order: Sequence[str], rows: int) -> DataFrame:
    """(id, cols) for ids 0..rows-1: the table's rows in order, started again when exhausted.

    Row r serves ids r, r + size, r + 2*size, ... so no join is needed.
    """
    wanted = list(dict.fromkeys([*order, *cols]))
    placed = ordered(table.select(*map(by_name, wanted)), list(order), index="__row")
    size = max(placed.rows, 1)
    table = placed.df.withColumn("__row", F.col("__row") - 1)
    if rows <= size:
        return table.where(F.col("__row") < rows).select(F.col("__row").alias("id"), *cols)
    # a short table may sit in one partition: spread blocks of repeats before they become rows
    step = F.lit(size * REPEATS).cast("bigint")
    blocks = table.select("*", F.explode(F.sequence(F.col("__row"), F.lit(rows - 1).cast("bigint"), step)).alias("__from"))
    blocks = blocks.repartition(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__from")
    last = F.least(F.col("__from") + F.lit(size * (REPEATS - 1)), F.lit(rows - 1))
    ids = F.sequence(F.col("__from"), last.cast("bigint"), F.lit(size).cast("bigint"))
    return blocks.select(F.explode(ids).alias("id"), *cols)


def generate_conditional(
    table: DataFrame,
    net: Network,
    data: Sequence[str],
    conditions: Sequence[str],
    order: Sequence[str],
    rows: int,
    noise: int,
    seed=0,
    how: str = "as_train",
    **forward,
) -> DataFrame:
    """`rows` rows (id, data, conditions) of G(z, y).

    how: 'as_train' takes y from the table's rows in order; 'uniform' draws from the distinct
    condition rows; a condition column's name pins that column at its maximum.
    """
    if how == "uniform":
        fed = _uniform_conditions(table, conditions, rows, seed)
    else:
        fed = repeat_rows(_pin(table, None if how == "as_train" else how), conditions, order, rows)
    fed = sample_noise(spread(fed, net, "id", rows), noise, "id", seed, "__z")
    out = dense_forward(fed, net, [*_noise_names(noise), *conditions], data, key="id", **forward)
    return out.select("id", *data, *conditions)


def generate_pinned(table, net, data, conditions, order, rows, noise, pinned: str, seed=0, **forward) -> DataFrame:
    return generate_conditional(table, net, data, conditions, order, rows, noise, seed, how=pinned, **forward)


def generate_uniform(table, net, data, conditions, rows, noise, seed=0, **forward) -> DataFrame:
    return generate_conditional(table, net, data, conditions, [], rows, noise, seed, how="uniform", **forward)


def _uniform_conditions(table: DataFrame, conditions: Sequence[str], rows: int, seed) -> DataFrame:
    distinct = ordered(table.select(*map(by_name, conditions)).distinct(), list(conditions), index="__row")
    ids = table.sparkSession.range(rows)
    ids = ids.select("id", (F.floor(uniform(seed, "condition", "id") * F.lit(float(distinct.rows))) + 1).alias("__row"))
    few = distinct.rows <= BROADCAST_ROWS  # otherwise every number is asked for rarely enough to shuffle
    return ids.join(F.broadcast(distinct.df) if few else distinct.df, "__row").select("id", *conditions)


def first_rows(table: DataFrame, order: str, rows: int) -> DataFrame:
    """The first `rows` rows by a unique key, as a filter on the key where it is a number."""
    size = table.count()
    if rows >= size:
        return table
    if is_numeric(table, order):
        found, _ = order_statistics(table, {"k": by_name(order)}, {"k": [rows]}, {"k": size})
        return table.where(by_name(order) <= F.lit(found["k"][0].value))
    return ordered(table, [order], index="__row").df.where(F.col("__row") <= rows).drop("__row")


def translate_a_to_b(
    table: DataFrame, net: Network, a: Sequence[str], b: Sequence[str], order: str, rows: int, **forward
) -> DataFrame:
    """(order, b) = G(a) for whole batches of 5000 until `rows` are reached; a shorter table just ends."""
    fed = first_rows(table, order, BATCH * -(-rows // BATCH)).select(*map(by_name, dict.fromkeys([order, *a])))
    out = dense_forward(spread(fed, net, order, rows), net, list(a), [f"__b_{c}" for c in b], key=order, **forward)
    return out.select(by_name(order), *[by_name(f"__b_{c}").alias(c) for c in b])


def reconstruction_error(
    table: DataFrame,
    net: Network,
    data: Sequence[str],
    conditions: Sequence[str],
    key: str,
    noise: int,
    seed=0,
    ids: Sequence[str] = (),
    pinned: str | None = None,
    agg: str = "max",
    rows: int | None = None,
    **forward,
) -> DataFrame:
    """(key, ids, error) with error = sum |x - G(z, y)| over the data columns of each training row."""
    fed = _pin(table, pinned, agg)
    if rows is not None:
        fed = first_rows(fed, key, BATCH * -(-rows // BATCH))
    fed = sample_noise(spread(fed, net, key, rows), noise, key, seed, "__z")
    names = [f"__g_{c}" for c in data]
    out = dense_forward(fed, net, [*_noise_names(noise), *conditions], names, key=key, **forward)
    error = sum((F.abs(by_name(c) - by_name(g)) for c, g in zip(data, names)), F.lit(0.0))
    return out.select(by_name(key), *[by_name(c) for c in ids if c != key], error.alias("error"))
