"""Two-dimensional Kolmogorov-Smirnov: quadrant shares, distances, p-values.

At every point the statistic asks how many points lie at or below it on both axes.
Comparing all pairs would be quadratic; here points are merged per distinct (x, y)
and numbered along each axis, which splits both axes into strips of equal size.
A point's count is then
    points of its own x-strip            (one task per x-strip)
  + points of its y-strip, lower x-strip (one task per y-strip)
  + points of cells lower on both        (a table of strip pairs).
Numbering by (x, y) and by (y, x) makes ranks unique, so ties never widen a strip.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import by_name
from ..functions.lookup import lookup
from ..functions.materialize import materialize
from ..functions.order import ordered, row_index
from ..functions.rng import uniform

STRIP_ROWS = 50_000
MAX_STRIPS = 2_048  # beyond it strips grow, so that the table of strip pairs stays small

_POINT = "rep int, x double, y double, rx bigint, ry bigint, i int, j int, w1 bigint, w2 bigint, c1 double, c2 double"


def counts_before(order: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each position p the summed weights of earlier positions with a smaller `order` value.

    `order` is a permutation of 0..m-1 and weights has one row per position. Blocks are
    merged bottom-up: in every pair of blocks the right one counts the left one.
    """
    m = len(order)
    out = np.zeros(weights.shape, dtype=np.float64)
    by_value = np.argsort(order, kind="stable")
    width = 1
    while width < m:
        pair = by_value // (2 * width)
        run = by_value[np.argsort(pair, kind="stable")]  # by pair of blocks, then by value
        left = (run // width) % 2 == 0
        summed = np.cumsum(np.where(left[:, None], weights[run], 0.0), axis=0)
        start = (run // (2 * width)) * (2 * width)  # pairs fill whole ranges of positions
        base = np.where((start > 0)[:, None], summed[np.maximum(start - 1, 0)], 0.0)
        out[run[~left]] += (summed - base)[~left]
        width *= 2
    return out


def _dense_rank(values: np.ndarray) -> np.ndarray:
    rank = np.empty(len(values), dtype=np.int64)
    rank[np.argsort(values, kind="stable")] = np.arange(len(values))
    return rank


def _in_x_strip(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("rx", kind="stable")
    w = pdf[["w1", "w2"]].to_numpy(dtype=np.float64)
    c = counts_before(_dense_rank(pdf["ry"].to_numpy()), w) + w  # a point counts itself
    return pdf.assign(c1=c[:, 0], c2=c[:, 1])


def _in_y_strip(pdf: pd.DataFrame) -> pd.DataFrame:
    # within one x-strip from high to low, so that only lower x-strips count
    pdf = pdf.sort_values(["i", "ry"], ascending=[True, False], kind="stable")
    w = pdf[["w1", "w2"]].to_numpy(dtype=np.float64)
    c = counts_before(_dense_rank(pdf["ry"].to_numpy()), w)
    return pdf.assign(c1=pdf["c1"] + c[:, 0], c2=pdf["c2"] + c[:, 1])


def _cells_below(pdf: pd.DataFrame) -> pd.DataFrame:
    """Weights of the cells strictly lower on both axes; at most MAX_STRIPS squared cells."""
    i, j = pdf["i"].to_numpy(), pdf["j"].to_numpy()
    out = pdf[["rep", "i", "j"]].copy()
    for w, g in (("w1", "g1"), ("w2", "g2")):
        grid = np.zeros((i.max() + 2, j.max() + 2))
        np.add.at(grid, (i + 1, j + 1), pdf[w].to_numpy(dtype=np.float64))
        out[g] = grid.cumsum(axis=0).cumsum(axis=1)[i, j]
    return out


def _dominated(weights: DataFrame, points: int, strip_rows: int) -> DataFrame:
    """`weights` (rep, x, y, rx, ry, w1, w2) with c1, c2: weight at or below each point on both axes."""
    size = max(strip_rows, math.ceil(points / MAX_STRIPS))
    placed = weights.select(
        "rep", "x", "y", "rx", "ry",
        F.floor((F.col("rx") - 1) / size).cast("int").alias("i"),
        F.floor((F.col("ry") - 1) / size).cast("int").alias("j"),
        "w1", "w2", F.lit(0.0).alias("c1"), F.lit(0.0).alias("c2"),
    )
    counted = placed.groupBy("rep", "i").applyInPandas(_in_x_strip, _POINT)
    if points <= size:
        return counted
    counted = counted.groupBy("rep", "j").applyInPandas(_in_y_strip, _POINT)
    cells = placed.groupBy("rep", "i", "j").agg(F.sum("w1").alias("w1"), F.sum("w2").alias("w2"))
    below = cells.groupBy("rep").applyInPandas(_cells_below, "rep int, i int, j int, g1 double, g2 double")
    # a cell holds at most one strip of points, so the join is balanced
    return counted.join(below, ["rep", "i", "j"]).withColumn("c1", F.col("c1") + F.col("g1")).withColumn("c2", F.col("c2") + F.col("g2"))


def _along(counted: DataFrame, axis: str, n1: int, n2: int, first_rep: int) -> DataFrame:
    """Add <axis>1, <axis>2: weight at or below the point on one axis.

    Each replicate weighs n1 and n2 in total, so one running sum over (rep, value) serves all.
    """
    groups = counted.groupBy("rep", axis).agg(F.sum("w1").alias("w1"), F.sum("w2").alias("w2"), F.count("*").alias("n"))
    run = ordered(groups, ["rep", axis], {f"{axis}1": "w1", f"{axis}2": "w2"}, index="__no").df
    for name, n in ((f"{axis}1", n1), (f"{axis}2", n2)):
        run = run.withColumn(name, by_name(name) - (F.col("rep") - first_rep) * F.lit(float(n)))
    return lookup(counted, run.select("rep", axis, f"{axis}1", f"{axis}2", "n"), ["rep", axis], "n")


class _Points:
    """Distinct pooled points with their ranks along both axes."""

    def __init__(self, df: DataFrame, sample: str, x: str, y: str, first):
        is_first = F.when(by_name(sample) == F.lit(first), 1).otherwise(0)
        # adding 0.0 joins negative and positive zero
        base = df.select(
            (by_name(x).cast("double") + F.lit(0.0)).alias("x"),
            (by_name(y).cast("double") + F.lit(0.0)).alias("y"),
            is_first.alias("s1"),
        )
        distinct = base.groupBy("x", "y").agg(F.sum("s1").alias("w1"), F.sum(F.lit(1) - F.col("s1")).alias("w2"))
        along_x = ordered(distinct, ["x", "y"], {"__1": "w1", "__2": "w2"}, index="rx")
        self.n1, self.n2 = int(along_x.totals["__1"]), int(along_x.totals["__2"])
        self.count = along_x.rows
        self.df = row_index(along_x.df.drop("__1", "__2"), ["y", "x"], index="ry")


def _shares(weights: DataFrame, points: _Points, strip_rows: int, first_rep: int = 0) -> DataFrame:
    """(rep, x, y, w1, w2, a1..d1, a2..d2): quadrant shares of both samples at each point."""
    n1, n2 = points.n1, points.n2
    counted = materialize(_dominated(weights, points.count, strip_rows).select("rep", "x", "y", "w1", "w2", "c1", "c2"))
    counted = _along(_along(counted, "x", n1, n2, first_rep), "y", n1, n2, first_rep)
    out = [by_name(c) for c in ("rep", "x", "y", "w1", "w2")]
    for s, n in (("1", n1), ("2", n2)):
        a = by_name(f"c{s}") / n
        b = (by_name(f"x{s}") - by_name(f"c{s}")) / n
        c = (by_name(f"y{s}") - by_name(f"c{s}")) / n
        out += [a.alias(f"a{s}"), b.alias(f"b{s}"), c.alias(f"c{s}_"), (F.lit(1.0) - a - b - c).alias(f"d{s}")]
    return counted.select(*out).withColumnsRenamed({"c1_": "c1", "c2_": "c2"})


def _observed(df: DataFrame, sample: str, x: str, y: str, first, strip_rows: int) -> tuple[DataFrame, _Points]:
    points = _Points(df, sample, x, y, first)
    weights = points.df.select(F.lit(0).alias("rep"), "x", "y", "rx", "ry", "w1", "w2")
    return _shares(weights, points, strip_rows), points


def quadrant_counts(df: DataFrame, sample: str, x: str, y: str, first, strip_rows: int = STRIP_ROWS) -> DataFrame:
    """Shares of both samples in the four quadrants at every distinct point; `first` marks sample 1.

    a: at or below on both axes, b: x at or below and y above, c: x above and y at or below, d: the rest.
    """
    shares, _ = _observed(df, sample, x, y, first, strip_rows)
    return shares.select("x", "y", *[f"{q}{s}" for s in "12" for q in "abcd"])


def _distance(own: str, other: str, n: int) -> tuple[list[Column], Column]:
    """Aggregates (min, max) over the points of sample `own`, and the distance made of them."""
    gaps = [by_name(f"{q}{own}") - by_name(f"{q}{other}") for q in "abcd"]
    gaps[0] = gaps[0] - F.lit(1.0 / n)
    mine = by_name(f"w{own}") > 0
    aggregates = [
        F.min(F.when(mine, F.least(*gaps))).alias(f"low{own}"),
        F.max(F.when(mine, F.greatest(*gaps))).alias(f"high{own}"),
    ]
    return aggregates, F.greatest(-by_name(f"low{own}"), by_name(f"high{own}") + F.lit(1.0 / n))


def _distances(shares: DataFrame, n1: int, n2: int) -> DataFrame:
    """(rep, d1, d2): largest quadrant difference seen from each sample."""
    first, d1 = _distance("1", "2", n1)
    second, d2 = _distance("2", "1", n2)
    return shares.groupBy("rep").agg(*first, *second).select("rep", d1.alias("d1"), d2.alias("d2"))


def maxdist(df: DataFrame, sample: str, x: str, y: str, first, strip_rows: int = STRIP_ROWS) -> DataFrame:
    """Largest quadrant difference at the points of sample 1."""
    shares, p = _observed(df, sample, x, y, first, strip_rows)
    return _distances(shares, p.n1, p.n2).select(F.col("d1").alias("maxdist"))


def avgmaxdist(df: DataFrame, sample: str, x: str, y: str, first, strip_rows: int = STRIP_ROWS) -> DataFrame:
    """Mean of the distances seen from either sample."""
    shares, p = _observed(df, sample, x, y, first, strip_rows)
    return _distances(shares, p.n1, p.n2).select(((F.col("d1") + F.col("d2")) / 2).alias("avgmaxdist"))


def kolmogorov_sf(d: Column) -> Column:
    """Tail of the Kolmogorov distribution; two series, each where it converges fast."""
    k = F.sequence(F.lit(1), F.lit(20))
    tail = F.aggregate(
        k, F.lit(0.0), lambda s, i: s + F.when(i % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * i * i * d * d)
    )
    head = F.aggregate(
        k,
        F.lit(0.0),
        lambda s, i: s + F.exp(-(F.lit(2) * i - 1) * (F.lit(2) * i - 1) * F.lit(math.pi**2 / 8.0) / (d * d)),
    )
    return F.when(d <= 0, 1.0).when(d < 1.0, 1.0 - F.lit(math.sqrt(2.0 * math.pi)) / d * head).otherwise(tail)


def _correlation(a: Column, b: Column) -> Column:
    """Pearson correlation, NULL for a constant side."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def ks2d(df: DataFrame, sample: str, x: str, y: str, first, strip_rows: int = STRIP_ROWS) -> DataFrame:
    """(statistic, p_value) of the two-sample test with the approximate distribution.

    Without a correlation (a constant axis, fewer than two rows) the p-value is NULL.
    """
    shares, p = _observed(df, sample, x, y, first, strip_rows)
    in_first = by_name(sample) == F.lit(first)
    both = [F.when(keep, by_name(c)) for keep in (in_first, ~in_first) for c in (x, y)]
    r1, r2 = df.agg(_correlation(both[0], both[1]), _correlation(both[2], both[3])).first()
    if r1 is None or r2 is None:
        stat = _distances(shares, p.n1, p.n2).select(((F.col("d1") + F.col("d2")) / 2).alias("statistic"))
        return stat.withColumn("p_value", F.lit(None).cast("double"))
    root = math.sqrt(p.n1 * p.n2 / (p.n1 + p.n2))
    r = math.sqrt(1.0 - 0.5 * (r1 * r1 + r2 * r2))
    stat = _distances(shares, p.n1, p.n2).select(((F.col("d1") + F.col("d2")) / 2).alias("statistic"))
    d = F.col("statistic") * F.lit(root) / F.lit(1.0 + r * (0.25 - 0.75 / root))
    return stat.select("statistic", kolmogorov_sf(d).alias("p_value"))


def bootstrap_distances(
    df: DataFrame, sample: str, x: str, y: str, first, key: str, nboot: int, seed=0, strip_rows: int = STRIP_ROWS
) -> tuple[DataFrame, _Points]:
    """(rep, statistic) for `nboot` resamples of the pooled rows; the first n1 draws form sample 1."""
    points = _Points(df, sample, x, y, first)
    n = points.n1 + points.n2
    later = F.when(by_name(sample) == F.lit(first), 0).otherwise(1)
    pooled = row_index(
        df.select(
            later.alias("later"),
            by_name(key).alias("key"),
            (by_name(x).cast("double") + F.lit(0.0)).alias("x"),
            (by_name(y).cast("double") + F.lit(0.0)).alias("y"),
        ),
        ["later", "key"],
    )
    # every pooled row knows the ranks of its point; points are few per (x, y), rows may be many
    ranked = lookup(pooled, points.df.select("x", "y", "rx", "ry", (F.col("w1") + F.col("w2")).alias("n")), ["x", "y"], "n")
    draws = df.sparkSession.range(nboot * n).select(
        (F.floor(F.col("id") / n) + 1).cast("int").alias("rep"), (F.col("id") % n).alias("slot")
    )
    drawn = draws.select(
        "rep",
        F.when(F.col("slot") < points.n1, 1).otherwise(0).alias("s1"),
        (F.floor(uniform(seed, "boot", "rep", "slot") * F.lit(float(n))) + 1).cast("bigint").alias("row_no"),
    )
    weights = (
        drawn.join(ranked, "row_no")
        .groupBy("rep", "x", "y", "rx", "ry")
        .agg(F.sum("s1").alias("w1"), F.sum(F.lit(1) - F.col("s1")).alias("w2"))
    )
    shares = _shares(weights, points, strip_rows, first_rep=1)
    out = _distances(shares, points.n1, points.n2)
    return out.select("rep", ((F.col("d1") + F.col("d2")) / 2).alias("statistic")), points


def ks2d_bootstrap(
    df: DataFrame, sample: str, x: str, y: str, first, key: str, nboot: int, seed=0, strip_rows: int = STRIP_ROWS
) -> DataFrame:
    """(statistic, p_value): share of resamples with a larger statistic than the observed one."""
    observed = avgmaxdist(df, sample, x, y, first, strip_rows).first()["avgmaxdist"]
    reps, _ = bootstrap_distances(df, sample, x, y, first, key, nboot, seed, strip_rows)
    larger = F.count_if(F.col("statistic") > F.lit(observed))
    return reps.agg(F.lit(observed).alias("statistic"), (larger / F.lit(float(nboot))).alias("p_value"))
