"""Reading, drawing, shuffling and writing of whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.columns import by_name
from ..functions.lookup import lookup
from ..functions.order import ordered, row_index
from ..functions.rng import uniform
from ..functions.selection import smallest

TOP_K_LIMIT = 10_000  # above this a sample is filtered in place instead of gathered
FIRST_SURROGATE_KEY = 200_000_000


def read_columns(spark: SparkSession, path: str, cols: Sequence[str], format: str = "parquet") -> DataFrame:
    """Only the named columns, in file order; the scan reads nothing else."""
    df = spark.read.format(format).load(path)
    return df.select(*[by_name(c) for c in df.columns if c in set(cols)])


def count_rows(df: DataFrame, asked: int = 0) -> int:
    """The asked number of rows, or the table's own when 0 is asked."""
    return asked if asked else df.count()


def sample_rows(df: DataFrame, k: int, key: str, seed=0) -> DataFrame:
    """k rows without replacement: those with the smallest keyed uniform."""
    u = uniform(seed, "sample", key)
    if k <= TOP_K_LIMIT:
        return df.orderBy(u, key).limit(k)
    return df.where(smallest(df, {"u": (u, k)}, key, df.count())["u"])


def draw_minibatches(
    df: DataFrame, key: str, batch_size: int, chunk_size: int, coverage: int = 1, seed=0, passes: int = 1
) -> DataFrame:
    """Random batches without replacement from consecutive chunks of `chunk_size` rows.

    A chunk of r rows gives coverage*(r // batch_size) batches, each drawn from the whole
    chunk. Each batch proposes row positions by keyed hash, keeps the first `batch_size`
    distinct ones, and joins them to the rows; proposals end with a run of consecutive
    positions, so a batch can always be filled. Work is linear in rows*coverage.
    `passes` repeats the whole file with fresh draws.
    """
    if batch_size < 1 or chunk_size < batch_size or chunk_size % batch_size or coverage < 1:
        raise ValueError("chunk_size must be a multiple of batch_size, coverage at least 1")
    placed = row_index(df, [key])
    chunked = placed.select(
        "*",
        F.floor((F.col("row_no") - 1) / chunk_size).cast("bigint").alias("chunk"),
    ).withColumn("__pos", F.col("row_no") - 1 - F.col("chunk") * chunk_size)
    chunks = chunked.groupBy("chunk").agg(F.count("*").alias("n"))
    draws = (
        chunks.where(F.col("n") >= batch_size)
        .select("chunk", "n", F.explode(F.sequence(F.lit(1), F.lit(passes))).alias("pass"))
        .select("*", F.explode(F.sequence(F.lit(1), F.floor(F.col("n") / batch_size).cast("int") * coverage)).alias("draw"))
    )
    # few rows now, many after the next step: spread the batches before each is filled
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    draws = draws.repartition(parts, "chunk", "pass", "draw")
    tries = F.when(F.col("n") >= 4 * batch_size, 2 * batch_size + 64).otherwise(6 * batch_size + 64)
    place = [F.lit(seed), F.col("chunk"), F.col("pass"), F.col("draw")]
    hashed = F.floor(uniform(seed, "batch", *place[1:], F.col("j")) * F.col("n"))
    run = (F.floor(uniform(seed, "batch", *place[1:], F.lit("run")) * F.col("n")) + F.col("j") - F.col("tries")) % F.col("n")
    proposals = (
        draws.withColumn("tries", tries)
        .select("*", F.explode(F.sequence(F.lit(0), F.col("tries") + batch_size - 1)).alias("j"))
        .select("chunk", "pass", "draw", "j", F.when(F.col("j") < F.col("tries"), hashed).otherwise(run).cast("bigint").alias("__pos"))
    )
    group = ["chunk", "pass", "draw"]
    kept = (
        proposals.groupBy(*map(by_name, group), "__pos").agg(F.min("j").alias("j"))
        # at most tries + batch_size proposals per batch
        .withColumn("slot", F.row_number().over(Window.partitionBy(*group).orderBy("j")))
        .where(F.col("slot") <= batch_size)
        .drop("j")
    )
    # sizes are guessed from before the proposals, so without the hint all batches would be broadcast through the driver
    return kept.hint("merge").join(chunked.hint("merge"), ["chunk", "__pos"]).select("pass", "chunk", "draw", "slot", *df.columns)


def perturb_rows(df: DataFrame, cols: Sequence[str], key: str, batch: str | None = None, seed=0) -> DataFrame:
    """x + 0.5 * s * U[0,1) per cell, s the population deviation of all cells of the row's batch.

    Sums are shifted by the overall mean, so large offsets do not cancel digits.
    """
    cells = len(cols)
    center = df.agg(*[F.avg(by_name(c)) for c in cols]).first()
    shift = sum(v or 0.0 for v in center) / cells
    total = sum((by_name(c) - F.lit(shift) for c in cols), F.lit(0.0))
    square = sum(((by_name(c) - F.lit(shift)) * (by_name(c) - F.lit(shift)) for c in cols), F.lit(0.0))
    group = [batch] if batch else []
    moments = df.groupBy(*map(by_name, group)).agg(F.count("*").alias("__rows"), F.sum(total).alias("__s"), F.sum(square).alias("__q"))
    mean = F.col("__s") / (F.col("__rows") * cells)
    moments = moments.withColumn("__std", F.sqrt(F.greatest(F.col("__q") / (F.col("__rows") * cells) - mean * mean, F.lit(0.0))))
    keys = [key] + ([batch] if batch else [])
    if batch:
        joined, std = lookup(df, moments.select(batch, "__rows", "__std"), [batch], "__rows"), F.col("__std")
    else:
        joined, std = df, F.lit(moments.first()["__std"])
    changed = {
        c: (by_name(c) + F.lit(0.5) * std * uniform(seed, f"perturb:{c}", *keys)).alias(c) for c in cols
    }
    return joined.select(*[changed.get(c, by_name(c)) for c in df.columns])


def shuffle_order(key: str, seed=0) -> list:
    return [uniform(seed, "shuffle", key), by_name(key)]


def shuffle_rows(df: DataFrame, key: str, seed=0) -> DataFrame:
    """Rows in a random order that depends only on the key and the seed."""
    return df.orderBy(*shuffle_order(key, seed))


def write_shuffled(df: DataFrame, path: str, key: str, seed=0) -> None:
    """Shuffled CSV with header; part files are in order."""
    shuffle_rows(df, key, seed).write.mode("overwrite").csv(path, header=True)


def restore_layout(
    df: DataFrame, header: Sequence[str], order: Sequence[str], key_name: str = "unq1", numbered: bool = False
) -> DataFrame:
    """Add the surrogate key 200000000, 200000001, ... and keep the header's columns in header order.

    `numbered` says that `order` is one column that already counts the rows from 0, as the ids
    of generated rows do; then nothing is sorted.
    """
    if numbered:
        keyed = df.withColumn(key_name, F.lit(FIRST_SURROGATE_KEY) + by_name(order[0]))
    else:
        keyed = ordered(df, list(order), index="__row").df
        keyed = keyed.withColumn(key_name, F.lit(FIRST_SURROGATE_KEY) + F.col("__row") - 1)
    return keyed.select(*[by_name(c) for c in header if c in keyed.columns])
