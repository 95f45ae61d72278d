"""Flags for missing and for very frequent values, and their inverse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import by_name, null_double, replace_columns
from ..functions.selection import Place, Profile, medians, middle_pairs, midway, profile, rank_value, smallest
from ..sources.stats import ColumnStats

MISSING_SHARE = 0.002  # a flag column from this share of missing rows on
FREQUENT_SHARE = 0.5  # a value held by more than this share of the non-missing rows ...
FREQUENT_DISTINCT = 30  # ... of a column with more distinct values than this


def _flag(marked: Column) -> Column:
    return F.when(marked, F.lit(-0.5)).otherwise(F.lit(0.5))


def missing_fit(df: DataFrame, cols: Sequence[str]) -> ColumnStats:
    known = profile(df, {c: by_name(c) for c in cols})
    rows, filled = known.rows, known.count
    middle, _ = medians(df, {c: by_name(c) for c in cols}, filled, known.grids)
    stats = ColumnStats("missing")
    for c in cols:
        share = (rows - filled[c]) / rows if rows else 0.0
        stats.columns[c] = {"nmissing": share}
        if share > MISSING_SHARE:
            stats.columns[c]["missing_column"] = f"{c}_missing"
        stats.columns[c]["median"] = middle[c]
    return stats


def missing_transform(df: DataFrame, stats: ColumnStats, cols: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Add the stored flag columns; returns their names too."""
    flags = {
        stats.columns[c]["missing_column"]: _flag(by_name(c).isNull())
        for c in cols or stats.columns
        if "missing_column" in stats.columns.get(c, {})
    }
    return replace_columns(df, flags), list(flags)


def missing_fit_transform(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str], ColumnStats]:
    stats = missing_fit(df, cols)
    out, flags = missing_transform(df, stats, cols)
    return out, flags, stats


def missing_back(df: DataFrame, stats: ColumnStats, key: str, cols: Sequence[str] = ()) -> DataFrame:
    """The round(share*rows) rows with the smallest flag become NULL, ties by key."""
    flagged = [c for c in cols or stats.columns if stats.columns[c].get("missing_column") in df.columns]
    flags = {c: (by_name(stats.columns[c]["missing_column"]), stats.columns[c]["nmissing"]) for c in flagged}
    rows, grids = _rows_and_grids(df, flags)
    picks = {c: (flags[c][0], _nearest(stats.columns[c]["nmissing"] * rows)) for c in flagged}
    marked = smallest(df, picks, key, rows, grids)
    return replace_columns(df, {c: F.when(~marked[c], by_name(c)) for c in picks})


def _rows_and_grids(df: DataFrame, flags: dict[str, tuple[Column, float]]) -> tuple[int, dict[str, list]]:
    """Row count, and approximate quantiles of each flag around the share of rows to pick."""
    known = profile(df, {n: rank_value(f) for n, (f, _) in flags.items()}, {n: [share] for n, (_, share) in flags.items()})
    return known.rows, known.grids


def _nearest(value: float) -> int:
    return int(round(value))  # half to even


def special_fit(df: DataFrame, cols: Sequence[str], frequencies: str = "all") -> ColumnStats:
    """Missing share, most frequent value with its share of non-missing rows, median after nulling it.

    `frequencies='all'` counts every value of every column and takes the most frequent,
    the smallest on ties. 'majority' only looks for values above one half: such a value
    covers the first, second or third quartile, so it is counted without a shuffle, and
    columns without one get no `highfreq` entry. Both give the same transform.
    """
    return special_fit_known(df, cols, frequencies)[0]


def special_fit_known(
    df: DataFrame, cols: Sequence[str], frequencies: str = "all"
) -> tuple[ColumnStats, Profile, dict[str, tuple[float, float]]]:
    """`special_fit`, with the profile of the columns and their middle pairs after nulling."""
    cols = list(cols)
    known = profile(df, {c: by_name(c) for c in cols})
    rows, filled, grids = known.rows, known.count, known.grids
    top = _most_frequent(df, cols) if frequencies == "all" else _majorities(df, filled, grids)
    stats = ColumnStats("special")
    removed = {}
    for c in cols:
        share = (rows - filled[c]) / rows if rows else 0.0
        s = stats.columns[c] = {"nmissing": share}
        if share > MISSING_SHARE:
            s["missing_column"] = f"{c}_missing"
        if c in top:
            place, distinct = top[c]
            s["nhighfreq"] = place.equal / filled[c]
            s["highfreq"] = place.value
            if s["nhighfreq"] > FREQUENT_SHARE and distinct > FREQUENT_DISTINCT:
                s["highfreq_column"] = f"{c}_highfreq"
                removed[c] = place
    pairs, _ = middle_pairs(df, {c: by_name(c) for c in cols}, filled, grids, without=removed)
    for c in cols:
        stats.columns[c]["median"] = midway(pairs.get(c))
    return stats, known, pairs


def _most_frequent(df: DataFrame, cols: list[str]) -> dict[str, tuple[Place, int]]:
    long = df.select(*[by_name(c).cast("double").alias(c) for c in cols]).unpivot([], [by_name(c) for c in cols], "col", "value")
    counted = long.where(F.col("value").isNotNull()).groupBy("col", "value").agg(F.count("*").alias("n"))
    top = counted.groupBy("col").agg(
        F.max(F.struct("n", (-F.col("value")).alias("negated"))).alias("top"), F.count("*").alias("distinct")
    )
    found = {r["col"]: (-r["top"]["negated"] + 0.0, r["top"]["n"], r["distinct"]) for r in top.collect()}
    if not found:
        return {}
    less = df.agg(*[F.count_if(by_name(c) < F.lit(v)) for c, (v, _, _) in found.items()]).first()
    return {c: (Place(v, below, n), distinct) for (c, (v, n, distinct)), below in zip(found.items(), less)}


def _majorities(df: DataFrame, filled: dict[str, int], grids: dict[str, list]) -> dict[str, tuple[Place, int]]:
    # a value of more than half of the rows covers a quartile, and about half of the grid
    candidates = {}
    for c, grid in grids.items():
        for v in dict.fromkeys(v for p, v in grid if p in (0.25, 0.5, 0.75)):
            shares = [p for p, x in grid if x == v]
            if shares[-1] - shares[0] > FREQUENT_SHARE - 0.05:
                candidates.setdefault(c, []).append(v)
    checks = [(c, v) for c, values in candidates.items() for v in values]
    if not checks:
        return {}
    row = df.agg(
        *[F.approx_count_distinct(by_name(c)) for c in candidates],
        *[f for c, v in checks for f in (F.count_if(by_name(c) < F.lit(v)), F.count_if(by_name(c) == F.lit(v)))],
    ).first()
    distinct, counted = dict(zip(candidates, row)), row[len(candidates) :]
    out = {}
    for i, (c, v) in enumerate(checks):
        place = Place(v, counted[2 * i], counted[2 * i + 1])
        if place.equal > FREQUENT_SHARE * filled[c]:
            out[c] = place
    # near the limit, few values are counted exactly
    near = [c for c in out if distinct[c] <= 4 * FREQUENT_DISTINCT]
    if near:
        distinct.update(zip(near, df.agg(*[F.count_distinct(by_name(c)) for c in near]).first()))
    return {c: (place, distinct[c]) for c, place in out.items()}


def _without_frequent(c: str, s: dict) -> Column:
    if "highfreq_column" not in s:
        return by_name(c)
    return F.when(by_name(c) != F.lit(s["highfreq"]), by_name(c))


def special_transform(
    df: DataFrame, stats: ColumnStats, cols: Sequence[str] = ()
) -> tuple[DataFrame, list[str], list[str]]:
    """Add both kinds of flags and null the frequent value; returns the flag names of each kind."""
    changed, missing, frequent = {}, [], []
    for c in cols or stats.columns:
        s = stats.columns.get(c, {})
        if "missing_column" in s:
            changed[s["missing_column"]] = _flag(by_name(c).isNull())
            missing.append(s["missing_column"])
        if "highfreq_column" in s:
            changed[s["highfreq_column"]] = _flag(by_name(c) == F.lit(s["highfreq"]))
            changed[c] = _without_frequent(c, s)
            frequent.append(s["highfreq_column"])
    return replace_columns(df, changed), missing, frequent


def special_fit_transform(
    df: DataFrame, cols: Sequence[str], frequencies: str = "all"
) -> tuple[DataFrame, list[str], list[str], ColumnStats]:
    stats = special_fit(df, cols, frequencies)
    return (*special_transform(df, stats, cols), stats)


def special_back(
    df: DataFrame, stats: ColumnStats, key: str, cols: Sequence[str] = (), exact_counts: bool = False
) -> DataFrame:
    """Frequent values first, then missing values, which override them; each by smallest flag, ties by key.

    The number of frequent rows is round(share*(rows - missing share)), as the formula has
    always been; `exact_counts` takes rows*(1 - missing share) instead.
    """
    flags = {
        name: (by_name(name), stats.columns[c][share])
        for c in cols or stats.columns
        for kind, share in (("highfreq_column", "nhighfreq"), ("missing_column", "nmissing"))
        if (name := stats.columns[c].get(kind)) in df.columns
    }
    rows, grids = _rows_and_grids(df, flags)
    picks: dict[str, tuple] = {}
    for c in cols or stats.columns:
        s = stats.columns[c]
        if s.get("highfreq_column") in flags:
            base = rows * (1.0 - s["nmissing"]) if exact_counts else rows - s["nmissing"]
            picks[s["highfreq_column"]] = (by_name(s["highfreq_column"]), _nearest(s["nhighfreq"] * base))
        if s.get("missing_column") in flags:
            picks[s["missing_column"]] = (by_name(s["missing_column"]), _nearest(s["nmissing"] * rows))
    marked = smallest(df, picks, key, rows, grids)
    changed = {}
    for c in cols or stats.columns:
        s = stats.columns[c]
        if c not in df.columns:
            continue
        value = by_name(c)
        if s.get("highfreq_column") in picks:
            value = F.when(marked[s["highfreq_column"]], F.lit(s["highfreq"])).otherwise(value)
        if s.get("missing_column") in picks:
            value = F.when(marked[s["missing_column"]], null_double()).otherwise(value)
        changed[c] = value
    return replace_columns(df, changed)
