"""Box-Cox: fitted by maximum likelihood, applied, inverted, and its comparison histograms.

With z = x / geometric mean the likelihood is largest where the variance of
(z^lambda - 1)/lambda is smallest. A first guess comes from approximate quantiles; each scan
then evaluates a few lambdas exactly for all columns at once, around the best so far.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import by_name, clip, not_nan, null_double, quoted, replace_columns
from ..functions.selection import Profile, middle_pairs, midway, profile
from ..sources.stats import ColumnStats

BINS = 30
_TRIES = 9  # lambdas per column and scan
_FINEST = 0.006  # half width of the last try
_AGGREGATES_PER_PASS = 200
_FAR = 1e6  # beyond it the likelihood counts as having no finite optimum


def _variance_columns(wanted: list[tuple[str, float]]) -> list[Column]:
    """var_pop of (z^lambda - 1)/lambda for each (log z as SQL text, lambda)."""
    return [F.expr(f"var_pop({log_z if lam == 0.0 else f'expm1({lam!r}D * ({log_z})) / {lam!r}D'})") for log_z, lam in wanted]


def _variances(df: DataFrame, wanted: list[tuple[str, float]]) -> list[float]:
    """Their values, as many as fit one scan."""
    out: list[float] = []
    for at in range(0, len(wanted), _AGGREGATES_PER_PASS):
        some = _variance_columns(wanted[at : at + _AGGREGATES_PER_PASS])
        out += list(df.agg(*[c.alias(f"v{i}") for i, c in enumerate(some)]).first())
    return out


def _guess(grid: list[tuple], low: float, high: float, shift: float, search: tuple[float, float]) -> float:
    """About the best lambda, from approximate quantiles alone."""
    shares, values = zip((0.0, low), *grid, (1.0, high))
    x = np.interp((np.arange(400) + 0.5) / 400, shares, np.asarray(values, float)) + shift
    z = np.log(x[x > 0])
    z = z - z.mean()
    centre, width = (search[0] + search[1]) / 2.0, max((search[1] - search[0]) / 2.0, 0.1)
    for _ in range(60):
        tries = centre + width * np.linspace(-1, 1, 41)
        with np.errstate(all="ignore"):
            scores = [np.var(z if lam == 0 else np.expm1(lam * z) / lam) for lam in tries]
        at = int(np.argmin(np.where(np.isfinite(scores), scores, np.inf)))
        centre = float(tries[at])
        if abs(centre) > _FAR:  # no use as a guess
            return (search[0] + search[1]) / 2.0
        width *= 10.0 if at in (0, 40) else 0.1
        if width < 0.005:
            break
    return round(centre, 2)


def _parabola(grid: list[float], scores: list[float], at: int) -> float:
    """Lowest point of the parabola through the best grid point and its neighbours."""
    a, b, c = scores[at - 1 : at + 2]
    bend = a - 2 * b + c
    return grid[at] + (0.5 * (grid[at + 1] - grid[at]) * (a - c) / bend if bend > 0 else 0.0)


def _tries(centre: float, width: float, step: float) -> list[float]:
    """Lambdas around a centre; the closest lie on multiples of `step`, whatever the centre."""
    middle = round(centre / step) * step if width <= _TRIES // 2 * step else centre
    return [round(middle + width * k / (_TRIES // 2), 12) for k in range(-(_TRIES // 2), _TRIES // 2 + 1)]


class _Lambdas:
    """Minimises the variance per column; with a resolution, over its multiples. None where it falls without end.

    Each scan tries some lambdas per column around a centre. A lowest point inside becomes the centre of a try a tenth
    as wide, one at the end the centre of a try ten times as wide. So the scans grow with the logarithm of the best lambda.
    """

    def __init__(self, logs: dict[str, str], guesses: dict[str, float], resolution: float | None):
        self.logs, self.resolution = logs, resolution
        self.finest = _TRIES // 2 * resolution if resolution else _FINEST
        self.step = resolution or _FINEST / (_TRIES // 2)
        self.centre = dict(guesses)
        near = self.finest if resolution else 10.0 * self.finest
        self.width = {c: max(near, abs(guesses[c]) / 20.0) for c in logs}
        self.best: dict[str, float | None] = {}

    def wanted(self) -> list[tuple[str, float]]:
        """(log z, lambda) of the next scan; none when all columns have their lambda."""
        self.grids = {c: _tries(self.centre[c], self.width[c], self.step) for c in self.logs if c not in self.best}
        return [(self.logs[c], lam) for c, grid in self.grids.items() for lam in grid]

    def take(self, scores: list[float], means: dict[str, float]) -> None:
        """The variances of `wanted`; `means` are the averages of the logarithms."""
        centre, width, best = self.centre, self.width, self.best
        for number, (c, grid) in enumerate(self.grids.items()):
            # dividing x by its geometric mean divides the variance by its power; powers out of range count as infinite
            got = []
            for v, lam in zip(scores[number * _TRIES :], grid):
                log_score = math.log(v) - 2.0 * lam * means[c] if v and math.isfinite(v) else math.inf
                got.append(log_score)
            at = min(range(_TRIES), key=lambda k: got[k])
            ends = at in (0, _TRIES - 1) or math.inf in (got[at - 1], got[at + 1])
            if ends and (abs(grid[at]) > _FAR or got[at] == math.inf or at not in (0, _TRIES - 1)):
                best[c] = None
            elif ends:
                centre[c], width[c] = grid[at], width[c] * 10.0
            elif width[c] <= self.finest:
                best[c] = grid[at] if self.resolution else _parabola(grid, got, at)
            else:
                centre[c], width[c] = _parabola(grid, got, at), max(width[c] / 10.0, self.finest)


def boxcox_fit(
    df: DataFrame,
    cols: Sequence[str],
    search: tuple[float, float] = (-2.0, 2.0),
    resolution: float | None = None,
) -> ColumnStats:
    """median, min, max, std, shift and lambd per column; a constant column, and one whose likelihood has no finite
    optimum, has no lambd and passes unchanged.

    `search` is the first interval tried; it moves on when the best value lies at its end.
    """
    return boxcox_fit_known(df, cols, search, resolution)[0]


def boxcox_fit_known(
    df: DataFrame,
    cols: Sequence[str],
    search: tuple[float, float] = (-2.0, 2.0),
    resolution: float | None = None,
    known: Profile | None = None,
    pairs: dict[str, tuple[float, float]] | None = None,
) -> tuple[ColumnStats, dict[str, tuple[float, float]]]:
    """`boxcox_fit` and the columns' middle pairs. Columns with both a known profile and pair are not searched again.

    One scan profiles the other columns; the next has medians, averages of logarithms and the first variances together.
    """
    cols = list(cols)
    known, pairs = known or Profile(), dict(pairs or {})
    new = [c for c in cols if c not in known.count]
    if new:
        known = known.joined(profile(df, {c: by_name(c) for c in new}))
    stats = ColumnStats("boxcox")
    for c in cols:
        low = known.low[c]
        shift = None if low is None else (1.0 - low if low <= 0 else 0.0)
        stats.columns[c] = {"median": None, "min": low, "max": known.high[c], "std": known.std[c], "shift": shift, "lambd": None}
    varied = [c for c in cols if known.count[c] and stats.columns[c]["min"] < stats.columns[c]["max"]]
    logs, guesses = {}, {}
    for c in varied:
        shift = float(stats.columns[c]["shift"])
        near = math.log(known.grids[c][len(known.grids[c]) // 2][1] + shift)  # keeps powers near 1
        logs[c] = f"(ln({quoted(c)} + {shift!r}D) - {near!r}D)"
        guesses[c] = _guess(known.grids[c], known.low[c], known.high[c], shift, search)
    lambdas = _Lambdas(logs, guesses, resolution)
    first = [F.expr(f"avg({text})") for text in logs.values()] + _variance_columns(lambdas.wanted())
    open_ = {c: by_name(c) for c in cols if c not in pairs}
    found, extras = middle_pairs(df, open_, known.count, known.grids, extra=first)
    pairs |= found
    for c in cols:
        stats.columns[c]["median"] = midway(pairs.get(c))
    means = dict(zip(varied, extras))
    lambdas.take(extras[len(varied) :], means)
    while more := lambdas.wanted():
        lambdas.take(_variances(df, more), means)
    for c in varied:
        stats.columns[c]["lambd"] = lambdas.best[c]
    return stats, pairs


def transformed_median(s: dict, pair: tuple[float, float] | None) -> float | None:
    """Median of the transformed column; the transform is increasing, so the middle pair is enough."""
    return midway(pair and (_forward_value(pair[0], s), _forward_value(pair[1], s)))


def _forward(value: Column, s: dict) -> Column:
    if s["lambd"] is None:
        return value
    shifted = value + F.lit(s["shift"])
    shifted = F.when(shifted > 0, shifted)
    if s["lambd"] == 0.0:
        return F.ln(shifted)
    lam = F.lit(float(s["lambd"]))
    return not_nan((F.pow(shifted, lam) - F.lit(1.0)) / lam)


def boxcox_transform(df: DataFrame, stats: ColumnStats, cols: Sequence[str] = ()) -> DataFrame:
    """x + shift, NULL where not positive; log for lambda 0, else (x^lambda - 1)/lambda."""
    wanted = [c for c in cols or stats.columns if c in stats.columns and c in df.columns]
    return replace_columns(df, {c: _forward(by_name(c), stats.columns[c]) for c in wanted})


def boxcox_fit_transform(
    df: DataFrame, cols: Sequence[str], search: tuple[float, float] = (-2.0, 2.0), resolution: float | None = None
) -> tuple[DataFrame, ColumnStats]:
    stats = boxcox_fit(df, cols, search, resolution)
    return boxcox_transform(df, stats, cols), stats


def boxcox_back(df: DataFrame, stats: ColumnStats, cols: Sequence[str] = ()) -> DataFrame:
    """Inverse, clipped to the fitted range; NULL where the inverse has no real value."""
    changed = {}
    for c in cols or stats.columns:
        s = stats.columns.get(c)
        if s is None or c not in df.columns or s["lambd"] is None:
            continue
        if s["lambd"] == 0.0:
            value = F.exp(by_name(c)) - F.lit(s["shift"])
        else:
            base = by_name(c) * F.lit(float(s["lambd"])) + F.lit(1.0)
            value = not_nan(F.pow(base, F.lit(1.0 / s["lambd"]))) - F.lit(s["shift"])
        changed[c] = clip(value, s["min"], s["max"])
    return replace_columns(df, changed)


def boxcox_hist(df: DataFrame, stats: ColumnStats, cols: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    """(col, kind, bin, n): histograms of the original, log and Box-Cox values, one scan for all.

    The transforms are increasing, so the ends of each range follow from the fitted min and max.
    """
    cells = []
    for c in cols or stats.columns:
        s = stats.columns[c]
        if s["min"] is None:
            continue
        shifted_log = {"lambd": 0.0, "shift": s["shift"]}
        for kind, form in (("original", None), ("log", shifted_log), ("boxcox", s)):
            low, high = [v if form is None else _forward_value(v, form) for v in (s["min"], s["max"])]
            value = by_name(c) if form is None else _forward(by_name(c), form)
            if high > low:
                place = F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(float(bins)))
                place = F.greatest(F.least(place, F.lit(bins - 1)), F.lit(0)).cast("int")
            else:  # a constant falls in the middle of a unit range around it
                place = F.lit(bins // 2)
            place = F.when(value.isNotNull(), place)
            cells.append(F.struct(F.lit(c).alias("col"), F.lit(kind).alias("kind"), place.alias("bin")))
    if not cells:
        return df.select(F.lit("").alias("col"), F.lit("").alias("kind"), F.lit(0).alias("bin"), F.lit(0).cast("long").alias("n")).limit(0)
    long = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where(F.col("bin").isNotNull())
    return long.groupBy("col", "kind", "bin").agg(F.count("*").alias("n"))


def _forward_value(value: float, s: dict) -> float:
    if s["lambd"] is None:
        return value
    x = value + s["shift"]
    return math.log(x) if s["lambd"] == 0.0 else (x ** s["lambd"] - 1.0) / s["lambd"]
