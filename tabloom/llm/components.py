"""Connected components by alternating large and small stars, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .stores import stored


def _with_least(pairs: DataFrame) -> DataFrame:
    """`pairs` (u, v) with m, the least v of each u; a node with many neighbours is aggregated first, then joined."""
    return pairs.join(pairs.groupBy("u").agg(F.min("v").alias("m")), "u")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in `links` (a, b); the component is its smallest id. No links: no rows."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges)
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours move to the least of the neighbourhood
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        # small star: smaller neighbours and the node itself move to the least one
        near = _with_least(large)
        small = near.select("u", F.col("m").alias("v")).unionByName(near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = stored(small.distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots).distinct()
