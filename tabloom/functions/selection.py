"""Exact order statistics by a few narrow aggregates: no sort and no shuffle of rows.

A quantile sketch brackets each wanted rank; one pass then counts exactly how many
values fall below, on and inside the bracket and lists the few inside. Where the
inside is too large to list, it is sketched again.

Sketches are merged in two levels: those of all input partitions into SKETCH_BUCKETS
summaries, in as many tasks, and these into one.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from .columns import by_name
from .order import row_index

LIST_LIMIT = 10_000  # values listed for one search in its last pass
SKETCH_BUCKETS = 64
SKETCH_SIZE = 16_384  # of a KLL sketch; it is off by 0.02 % of all ranks at most
_ACCURACY = 5_000
_MARGIN = 3 / _ACCURACY  # more than a sketch can be off
_EVEN = [i / 200 for i in range(1, 200)]  # shares that every profile knows
_AGGREGATES_PER_PASS = 120
_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


@dataclass
class Place:
    """A value at a wanted rank, with how many values are smaller and how many equal it."""

    value: object
    less: int
    equal: int


@dataclass
class _Search:
    """Wanted ranks among the values strictly between low and high; `less` values lie at or below low."""

    name: str
    value: Column
    ranks: list[int]
    less: int
    inside: int
    low: object = None
    high: object = None
    grid: list = field(default_factory=list)

    def within(self, low, high) -> Column:
        keep = self.value.isNotNull()
        if low is not None:
            keep = keep & (self.value > F.lit(low))
        if high is not None:
            keep = keep & (self.value < F.lit(high))
        return keep

    def listed(self, low, high) -> Column:
        return F.collect_list(F.when(self.within(low, high), self.value))

    def bracket(self) -> tuple:
        """Sketched values that enclose the wanted ranks, and about how many values lie between them."""
        first = (self.ranks[0] - self.less - 1) / self.inside - 1 / _ACCURACY
        last = (self.ranks[-1] - self.less) / self.inside + 1 / _ACCURACY
        left = max((g for g in self.grid if g[0] <= first), default=self.grid[0])
        right = min((g for g in self.grid if g[0] >= last), default=self.grid[-1])
        return left[1], right[1], (right[0] - left[0]) * self.inside

    def shares(self) -> list[float]:
        return [(r - self.less) / self.inside for r in (self.ranks[0], self.ranks[-1])]

    def part(self, ranks, less, inside, low, high) -> "_Search":
        return _Search(self.name, self.value, ranks, less, inside, low, high)


def _points(probabilities: Sequence[float]) -> list[float]:
    around = [p + d for p in probabilities for d in (-_MARGIN, _MARGIN)]
    return sorted({0.25, 0.5, 0.75, *[min(max(p, 0.0), 1.0) for p in around]})


@dataclass
class Profile:
    """Rows of a table and, per column, non-null values, least, largest, mean, deviation (n - 1) and a grid of
    (share, approximate quantile)."""

    rows: int = 0
    count: dict[str, int] = field(default_factory=dict)
    low: dict = field(default_factory=dict)
    high: dict = field(default_factory=dict)
    mean: dict[str, float | None] = field(default_factory=dict)
    std: dict[str, float | None] = field(default_factory=dict)
    grids: dict[str, list] = field(default_factory=dict)

    def joined(self, other: "Profile") -> "Profile":
        """Both profiles; a column of `other` takes precedence."""
        parts = ("count", "low", "high", "mean", "std", "grids")
        return Profile(self.rows, *[getattr(self, n) | getattr(other, n) for n in parts])


def _last(values: Sequence):
    """The largest as Spark orders them: NaN above all."""
    return max(values, key=lambda v: (v != v, 0 if v != v else v), default=None)


def profile(df: DataFrame, values: Mapping[str, Column], around: Mapping[str, Sequence[float]] | None = None) -> Profile:
    """One scan for all of `values`. Their grids have even shares and those just beside `around` (the median by default)."""
    names = list(values)
    plain = df.select(*[values[n].alias(f"v{i}") for i, n in enumerate(names)])
    kinds = ["bigint" if t in _INTEGRAL else "double" for _, t in plain.dtypes]
    points = [sorted({*_EVEN, *_points((around or {}).get(n, (0.5,)))}) for n in names]
    first, second, out = [F.count("*").alias("rows")], [F.sum("rows").alias("rows")], [F.col("rows")]
    for i, kind in enumerate(kinds):
        v, (make, merge, ask) = F.col(f"v{i}"), [getattr(F, f"kll_{f}_{kind}") for f in ("sketch_agg", "merge_agg", "sketch_get_quantile")]
        moments = F.struct(F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_pop(v).alias("spread"), F.min(v).alias("low"), F.max(v).alias("high"))
        first += [moments.alias(f"m{i}"), make(v.cast(kind), F.lit(SKETCH_SIZE)).alias(f"s{i}")]
        seen = F.when(F.col(f"m{i}.n") > 0, F.col(f"s{i}"))  # no summary of a bucket without values
        second += [F.collect_list(f"m{i}").alias(f"m{i}"), merge(seen, F.lit(SKETCH_SIZE)).alias(f"s{i}"), F.sum(f"m{i}.n").alias(f"n{i}")]
        out += [F.col(f"m{i}"), F.when(F.col(f"n{i}") > 0, ask(f"s{i}", F.array(*map(F.lit, points[i]))))]
    bucket = F.pmod(F.spark_partition_id(), F.lit(SKETCH_BUCKETS)).alias("bucket")
    row = plain.groupBy(bucket).agg(*first).agg(*second).select(*[c.alias(f"o{i}") for i, c in enumerate(out)]).first()
    done = Profile(row[0] or 0)
    for i, n in enumerate(names):
        parts = [m for m in row[1 + 2 * i] if m["n"]]
        size = done.count[n] = sum(m["n"] for m in parts)
        done.low[n] = min((m["low"] for m in parts if m["low"] == m["low"]), default=_last([m["low"] for m in parts]))
        done.high[n] = _last([m["high"] for m in parts])
        mean = done.mean[n] = sum(m["n"] * m["mean"] for m in parts) / size if size else None
        squares = sum(m["n"] * (m["spread"] + (m["mean"] - mean) ** 2) for m in parts)
        done.std[n] = math.sqrt(squares / (size - 1)) if size > 1 else None
        done.grids[n] = list(zip(points[i], row[2 + 2 * i] or []))
    return done


def _run(df: DataFrame, aggregates: list[Column]) -> list:
    out: list = []
    for at in range(0, len(aggregates), _AGGREGATES_PER_PASS):
        block = [c.alias(f"a{i}") for i, c in enumerate(aggregates[at : at + _AGGREGATES_PER_PASS])]
        out += list(df.agg(*block).first())
    return out


def _take(found: dict, s: _Search, ranks: list[int], less: int, listed: Sequence) -> None:
    """Places of ranks among `listed`, which holds everything between two known values."""
    values = sorted(listed)
    for r in ranks:
        v = values[r - less - 1]
        below = next(i for i, x in enumerate(values) if x == v)
        found[(s.name, r)] = Place(v, less + below, values.count(v))


def _narrow(found: dict, s: _Search, a, b, counts, listed) -> list[_Search]:
    """Settle the ranks that the counts decide; return searches for the others."""
    below, on_a, middle, on_b, above = counts
    less_a = s.less + below
    less_m = less_a + on_a
    less_b = less_m + middle
    less_z = less_b + on_b
    parts: dict[str, list[int]] = {"below": [], "middle": [], "above": []}
    for r in s.ranks:
        if r <= less_a:
            parts["below"].append(r)
        elif r <= less_m:
            found[(s.name, r)] = Place(a, less_a, on_a)
        elif r <= less_b:
            parts["middle"].append(r)
        elif r <= less_z:
            found[(s.name, r)] = Place(b, less_b, on_b)
        else:
            parts["above"].append(r)
    out = []
    if parts["below"]:
        out.append(s.part(parts["below"], s.less, below, s.low, a))
    if parts["middle"]:
        if listed is not None:
            _take(found, s, parts["middle"], less_m, listed)
        else:
            out.append(s.part(parts["middle"], less_m, middle, a, b))
    if parts["above"]:
        out.append(s.part(parts["above"], less_z, above, b, s.high))
    return out


def order_statistics(
    df: DataFrame,
    values: Mapping[str, Column],
    ranks: Mapping[str, Sequence[int]],
    counts: Mapping[str, int] | None = None,
    grids: Mapping[str, Sequence] | None = None,
    extra: Sequence[Column] = (),
) -> tuple[dict[str, list[Place]], list]:
    """For each name the places of the given 1-based ranks among its non-null values, ascending.

    `counts` (non-null values) and `grids` (of their `profile`) save passes when the caller has
    them. `extra` aggregates ride along in the first pass; their results come second.
    """
    grids = grids or {}
    if counts is None:
        counts = dict(zip(values, _run(df, [F.count(v) for v in values.values()])))
    open_: list[_Search] = []
    for name, value in values.items():
        wanted = sorted(set(ranks[name]))
        if wanted and not 1 <= wanted[0] <= wanted[-1] <= counts[name]:
            raise ValueError(f"ranks {wanted} of {name} are outside 1..{counts[name]}")
        near: list[list[int]] = []
        for r in wanted:  # neighbouring ranks share a search
            if near and r - near[-1][0] <= max(counts[name] // _ACCURACY, 1):
                near[-1].append(r)
            else:
                near.append([r])
        open_ += [_Search(name, value, group, 0, counts[name], grid=list(grids.get(name) or ())) for group in near]

    found: dict[tuple[str, int], Place] = {}
    extras: list = []
    pending = list(extra)
    while open_ or pending:
        aggregates: list[Column] = list(pending)
        steps: list[tuple] = []
        bare: list[_Search] = []  # to be sketched first
        for s in open_:
            if s.inside <= LIST_LIMIT:
                steps.append((s, "list", None))
                aggregates.append(s.listed(s.low, s.high))
            else:
                if not s.grid:
                    bare.append(s)
                    continue
                a, b, expected = s.bracket()
                final = expected + 4 * s.inside / _ACCURACY <= LIST_LIMIT
                steps.append((s, "count", (a, b, final)))
                inside, middle, none = s.within(s.low, s.high), s.within(a, b), F.lit(0).cast("bigint")
                aggregates += [
                    F.count_if(inside & (s.value < F.lit(a))),
                    F.count_if(s.value == F.lit(a)),
                    F.count_if(middle) if a != b else none,
                    F.count_if(s.value == F.lit(b)) if a != b else none,
                    F.count_if(inside & (s.value > F.lit(b))),
                    *([s.listed(a, b)] if final else []),
                ]
        if bare:
            inner = profile(df, {str(i): F.when(s.within(s.low, s.high), s.value) for i, s in enumerate(bare)}, {str(i): s.shares() for i, s in enumerate(bare)})
            for i, s in enumerate(bare):
                s.grid = inner.grids[str(i)]
        got = iter(_run(df, aggregates) if aggregates else [])
        extras += [next(got) for _ in pending]
        pending, open_ = [], bare
        for s, kind, how in steps:
            if kind == "list":
                _take(found, s, s.ranks, s.less, next(got))
            else:
                a, b, final = how
                counted = [next(got) for _ in range(5)]
                open_ += _narrow(found, s, a, b, counted, next(got) if final else None)
    return {name: [found[(name, r)] for r in ranks[name]] for name in values}, extras


def _ends(
    df: DataFrame,
    values: Mapping[str, Column],
    probabilities: Sequence[float],
    counts: Mapping[str, int],
    grids: Mapping[str, Sequence] | None,
    extra: Sequence[Column],
    without: Mapping[str, Place] | None,
) -> tuple[dict[str, list[tuple]], list]:
    """Per name with values and probability: the two observed values around the quantile, and its place between them."""
    without = without or {}
    spots, ranks, moved = {}, {}, {}
    for n in values:
        skip = without.get(n)
        size = counts[n] - (skip.equal if skip else 0)
        if size <= 0:
            continue
        spots[n] = [(size - 1) * p for p in probabilities]
        own = sorted({int(f(s)) + 1 for s in spots[n] for f in (math.floor, math.ceil)})
        moved[n] = {r: r + skip.equal if skip and r > skip.less else r for r in own}
        ranks[n] = sorted(moved[n].values())
    found, extras = order_statistics(df, {n: values[n] for n in ranks}, ranks, counts, grids, extra)
    out = {}
    for n in ranks:
        by_rank = {r: place.value for r, place in zip(ranks[n], found[n])}
        at = lambda r: float(by_rank[moved[n][r]])  # noqa: B023, E731
        out[n] = [(at(math.floor(s) + 1), at(math.ceil(s) + 1), s - math.floor(s)) for s in spots[n]]
    return out, extras


def exact_quantiles(
    df: DataFrame,
    values: Mapping[str, Column],
    probabilities: Sequence[float],
    counts: Mapping[str, int],
    grids: Mapping[str, Sequence] | None = None,
    extra: Sequence[Column] = (),
    without: Mapping[str, Place] | None = None,
) -> tuple[dict[str, list], list]:
    """Exact linear-interpolation quantiles of the non-null values, None where there are none.

    `without` leaves out all copies of one value per name: the ranks above it just move up.
    """
    ends, extras = _ends(df, values, probabilities, counts, grids, extra, without)
    return {n: [a + share * (b - a) for a, b, share in ends[n]] if n in ends else [None] * len(probabilities) for n in values}, extras


def middle_pairs(
    df: DataFrame,
    values: Mapping[str, Column],
    counts: Mapping[str, int],
    grids: Mapping[str, Sequence] | None = None,
    extra: Sequence[Column] = (),
    without: Mapping[str, Place] | None = None,
) -> tuple[dict[str, tuple[float, float]], list]:
    """The two observed values whose mean is the median, equal ones for an odd count; no entry without values.

    An increasing function of the column has its median midway between the function's values at these.
    """
    ends, extras = _ends(df, values, [0.5], counts, grids, extra, without)
    return {n: e[0][:2] for n, e in ends.items()}, extras


def midway(pair: tuple[float, float] | None) -> float | None:
    return pair and pair[0] + 0.5 * (pair[1] - pair[0])


def medians(
    df: DataFrame,
    values: Mapping[str, Column],
    counts: Mapping[str, int],
    grids: Mapping[str, Sequence] | None = None,
    extra: Sequence[Column] = (),
    without: Mapping[str, Place] | None = None,
) -> tuple[dict[str, float | None], list]:
    found, extras = exact_quantiles(df, values, [0.5], counts, grids, extra, without)
    return {n: q[0] for n, q in found.items()}, extras


def is_numeric(df: DataFrame, name: str) -> bool:
    return dict(df.dtypes)[name].split("(")[0] in ("tinyint", "smallint", "int", "bigint", "float", "double")


def rank_value(value: Column) -> Column:
    """The value by which `smallest` ranks: null and NaN come last."""
    last = F.lit(float("inf"))
    return F.coalesce(F.nanvl(value.cast("double"), last), last)


def smallest(
    df: DataFrame,
    picks: Mapping[str, tuple[Column, int]],
    key: str,
    rows: int,
    grids: Mapping[str, Sequence] | None = None,
) -> dict[str, Column]:
    """For each (value, k) a predicate true on exactly the k rows smallest by (value, key).

    The table is only scanned by aggregates; the predicate itself is row-local. A row without a key is not picked among ties.
    `grids` are those of a profile of `rank_value(value)` if the caller has one.
    """
    out = {n: F.lit(k >= rows) for n, (_, k) in picks.items() if k <= 0 or k >= rows}
    names = [n for n in picks if n not in out]
    if not names:
        return out
    value = {n: rank_value(picks[n][0]) for n in names}
    k = {n: picks[n][1] for n in names}
    found, _ = order_statistics(df, value, {n: [k[n]] for n in names}, dict.fromkeys(names, rows), grids)
    limit = {n: found[n][0] for n in names}
    on_limit = {n: value[n] == F.lit(limit[n].value) for n in names}
    partial = {n: k[n] - limit[n].less for n in names if k[n] < limit[n].less + limit[n].equal}
    key_limit: dict[str, object] = {}
    if partial and is_numeric(df, key):
        tied_keys = {n: F.when(on_limit[n], by_name(key)) for n in partial}
        tied = {n: limit[n].equal for n in partial}
        got, _ = order_statistics(df, tied_keys, {n: [partial[n]] for n in partial}, tied)
        key_limit = {n: got[n][0].value for n in partial}
    else:
        for n in partial:
            ranked = row_index(df.where(on_limit[n]).select(by_name(key)), [key])
            key_limit[n] = ranked.where(F.col("row_no") == partial[n]).first()[key]
    for n in names:
        last = on_limit[n] & F.coalesce(by_name(key) <= F.lit(key_limit[n]), F.lit(False)) if n in key_limit else on_limit[n]
        out[n] = (value[n] < F.lit(limit[n].value)) | last
    return out
