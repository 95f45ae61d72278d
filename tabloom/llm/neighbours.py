"""Approximate nearest neighbours through a permutation index.

A vector is represented by its nearest pivots in order. A shard of vectors posts them, with their place in that order, in
one list per pivot. A query adds up, over the lists of its own nearest pivots, how far the places differ (footrule
distance); the closest share of a shard is ranked again by exact distance in double precision.

Every row is indexed. Equal vectors are one entry with its smallest ids, so a vector that fills a third of the table is one
candidate. Shards and blocks of queries have bounded sizes, and each block meets each shard once; only the nearest
of each pair leave a task. All candidates as close as the last one taken are taken too, so a cluster whose vectors share one
order is ranked exactly.

Defined results: vectors that are null, zero, of another size than most (of equally frequent
sizes the larger counts), or hold a null or non-finite component take no
part. Ties go to the smaller id. A query's own id is never among its answers; rows that repeat an id count as often as they
occur. With fewer candidates than asked for, all are returned; without queries or candidates there are no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .stores import stored

PIVOTS = 512  # taken from the vectors by a hash of their values
PLACES = 160  # nearest pivots that represent a vector
SHARD_ROWS = 4096
BLOCK_QUERIES = 2048
SHARE = 1 / 5  # of a shard that is ranked again
LEAST = 64


def _orders(x: np.ndarray, pivots: np.ndarray, places: int) -> np.ndarray:
    """Numbers of the nearest pivots of each row, nearest first."""
    away = (pivots**2).sum(axis=1) - 2 * x @ pivots.T
    return np.argsort(away, axis=1, kind="stable")[:, :places]


class Shard:
    """Inverted lists of one shard."""

    def __init__(self, x: np.ndarray, pivots: np.ndarray, places: int):
        self.x, self.pivots, self.places = x, pivots, min(places, len(pivots))
        order = _orders(x, pivots, self.places)
        by = np.argsort(order.ravel(), kind="stable")
        self.starts = np.searchsorted(order.ravel()[by], np.arange(len(pivots) + 1))
        self.rows, self.place = by // self.places, by % self.places

    def footrules(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of every row to a query's order; a pivot that a row lacks counts as just behind its last."""
        gains, rows = [], []
        for place, p in enumerate(order.tolist()):
            a, b = self.starts[p], self.starts[p + 1]
            rows.append(self.rows[a:b])
            gains.append((self.places - place) - np.abs(self.place[a:b] - place))
        gain = np.bincount(np.concatenate(rows), weights=np.concatenate(gains), minlength=len(self.x))
        return self.places * (self.places + 1) / 2 - gain

    def nearest(self, q: np.ndarray, order: np.ndarray, share: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact distances) of the closest share by footrule."""
        want = max(least, int(len(self.x) * share))
        rows = np.arange(len(self.x))
        if want < len(rows):
            away = self.footrules(order)
            rows = np.flatnonzero(away <= np.partition(away, want - 1)[want - 1])
        return rows, np.sqrt(((self.x[rows] - q) ** 2).sum(axis=1))


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _search(pivots: np.ndarray, k: int, share: float, least: int):
    size = pivots.shape[1]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found_q, found_v, found_d = [], [], []
        if left.num_rows and right.num_rows:
            shard = Shard(_matrix(left.column("vector"), size), pivots, PLACES)
            members = left.column("ids").to_pylist()
            least_id = np.array([m[0] for m in members])
            queries = _matrix(right.column("vector"), size)
            orders = _orders(queries, pivots, shard.places)
            for q, own, order in zip(queries, right.column("query").to_pylist(), orders):
                rows, away = shard.nearest(q, order, share, least)
                first = np.lexsort((least_id[rows], away))[: k + 1]
                near = sorted((float(away[i]), v) for i in first.tolist() for v in members[rows[i]] if v != own)[:k]
                found_q += [own] * len(near)
                found_d += [d for d, _ in near]
                found_v += [v for _, v in near]
        return pa.table({"query": pa.array(found_q, pa.int64()), "vec": pa.array(found_v, pa.int64()), "away": pa.array(found_d, pa.float64())})

    return run


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    pivots: int = PIVOTS,
    share: float = SHARE,
    least: int = LEAST,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that `queries` selects its `k` nearest, by Euclidean distance."""
    rows = vectors.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks")
    )
    rows = rows.where(usable(F.col("vector")))
    usual = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    rows = rows.where(F.size("vector") == (usual["size"] if usual else 0))
    chosen = rows.groupBy("vector").agg(F.min("id").alias("id")).orderBy(F.xxhash64("vector"), "id").limit(pivots).select("vector").collect()
    out = "query long, vec long, away double"
    if not chosen:
        empty = rows.select(F.col("id").alias("query"), F.col("id").alias("vec"), F.lit(0.0).alias("away")).limit(0)
        return _ranked(empty, k)
    centers = np.array([r[0] for r in chosen])
    # the k + 1 smallest ids of each vector are all that an answer can hold; the limit is applied before the shuffle
    first = rows.select("id", "vector").withColumn("n", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("n") <= k + 1)
    entries = stored(first.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    asked = stored(rows.where("asks").select(F.col("id").alias("query"), "vector").distinct())
    shards = max(1, -(-entries.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = entries.select(F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"), each(blocks).alias("block"), "vector", "ids")
    right = asked.select(each(shards).alias("shard"), F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block"), "query", "vector")
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(_search(centers, k, share, least), out)
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query").orderBy("away", "vec"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select(
        F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("vec").alias("vec_id"), F.col("away").alias("score")
    )
