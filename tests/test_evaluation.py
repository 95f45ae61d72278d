"""Metrics and two-sample tests against direct numpy formulas."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import energy as en
from tabloom.operators import lines, ranking
from tabloom.operators import quadrants as qd


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(11)
    n = 1_000
    pdf = pd.DataFrame({"k": range(n), "y": (rng.random(n) < 0.3).astype(float), "w": rng.integers(1, 4, n).astype(float)})
    pdf["p"] = np.where(np.arange(n) % 3 == 0, 0.4, np.round(rng.random(n) + 0.2 * pdf.y, 2))  # heavy ties
    pdf["t"] = rng.gamma(2.0, 2.0, n).round(1)
    return pdf


def test_jsd_with_disjoint_bins(spark):
    p = spark.createDataFrame([(0, 2), (1, 2)], "bin int, n int")
    q = spark.createDataFrame([(1, 1), (2, 3)], "bin int, n int")
    a, b = np.array([0.5, 0.5, 0.0]), np.array([0.0, 0.25, 0.75])
    kl = lambda u, v: sum(x * math.log(x / y) for x, y in zip(u, v) if x)
    assert np.isclose(ranking.jsd(p, q).first()["jsd"], (kl(a, (a + b) / 2) + kl(b, (a + b) / 2)) / 2)
    assert ranking.jsd(p, p).first()["jsd"] == 0.0
    alone = spark.createDataFrame([(9, 1)], "bin int, n int")
    assert np.isclose(ranking.jsd(p, alone).first()["jsd"], math.log(2))


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_ranking_metrics(spark, scores, parts):
    df = spark.createDataFrame(scores).repartition(parts)
    pos, neg = scores[scores.y == 1].p.to_numpy(), scores[scores.y == 0].p.to_numpy()
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert np.isclose(ranking.gini_binary(df, "y", "p").first()["gini"], 100 * (2 * auc - 1))

    def area(order):
        y = scores.sort_values(order, ascending=[False, True]).t.to_numpy()
        return (np.linspace(1 / len(y), 1, len(y)) - np.cumsum(y) / y.sum()).sum()

    assert np.isclose(ranking.gini(df, "t", "p", "k").first()["gini"], area(["p", "k"]) / area(["t", "k"]))

    s = scores.sort_values(["p", "k"], ascending=[False, True])
    weight = np.where(s.y == 0, 100 / 20.0, 1.0)
    cut = np.abs(np.cumsum(weight) - 0.1 * weight.sum()).argmin()
    got = ranking.capture_rate(df, "y", "p", "k", at=10.0, sample_size=20.0).first()["capture_rate"]
    assert np.isclose(got, 100 * s.y.to_numpy()[:cut].sum() / s.y.sum())

    for name in (None, "w"):
        w = s.w.to_numpy() if name else np.ones(len(s))
        bins = np.minimum(np.floor(np.cumsum(w) / w.sum() * 10) + 1, 10)
        per = pd.DataFrame({"b": bins, "p": s.p.to_numpy() * w, "y": s.y.to_numpy() * w}).groupby("b").sum()
        got = ranking.accuracy_index(df, "y", "p", "k", name).first()["accuracy_index"]
        assert np.isclose(got, 1 - (per.p - per.y).abs().sum() / per.y.abs().sum())


def test_accuracy_index_without_any_truth_is_null(spark):
    df = spark.createDataFrame([(1, 0.0, 0.3), (2, 0.0, 0.1)], "k int, y double, p double")
    assert ranking.accuracy_index(df, "y", "p", "k").first()["accuracy_index"] is None


def diagonal(pdf):
    d = pdf.dropna().copy()
    options = np.array(sorted(pdf.opt.unique()))
    d["final"] = options[np.abs(d.final.to_numpy()[:, None] - options).argmin(axis=1)]
    g = d.groupby(["final", "opt"]).cmv
    d = d[(d.cmv > g.transform(lambda x: np.percentile(x, 1))) & (d.cmv < g.transform(lambda x: np.percentile(x, 99)))]
    if not len(d):
        return 0.0
    means = d[d.final == d.opt].groupby("opt").cmv.mean()
    counts = d.groupby("opt").size()[means.index]
    return (means * counts).sum() / counts.sum()


@pytest.mark.parametrize("few", [64, 2])
def test_diagonal_margin(spark, monkeypatch, few):
    monkeypatch.setattr(lines, "FEW_LINES", few)
    rng = np.random.default_rng(12)
    pdf = pd.DataFrame({"k": range(3_000), "final": rng.integers(0, 41, 3_000).astype(float), "opt": rng.choice([0.0, 10.0, 20.0, 40.0], 3_000)})
    pdf["cmv"] = rng.normal(size=3_000)
    df = spark.createDataFrame(pdf)
    assert np.isclose(lines.diagonal_cmv(df, "final", "opt", "cmv", "k").first()["diagonal_cmv"], diagonal(pdf))
    lone = spark.createDataFrame([(1, 0.0, 0.0, 5.0)], "k int, final double, opt double, cmv double")
    assert lines.diagonal_cmv(lone, "final", "opt", "cmv", "k").first()["diagonal_cmv"] == 0.0


def plain_limits(pdf):
    g = pdf.groupby(["f", "o"]).cmv
    d = pdf[(pdf.cmv > g.transform(lambda x: np.percentile(x, 1))) & (pdf.cmv < g.transform(lambda x: np.percentile(x, 99)))]
    return d.groupby(["f", "o"]).cmv.agg(["size", "sum"])


@pytest.mark.parametrize("margins", [(0.003, 0.05, 1.0), (1e-7, 0.05, 1.0), (1.0,)])
def test_cells_are_cut_at_exact_percentiles(spark, monkeypatch, margins):
    monkeypatch.setattr(lines, "MARGINS", margins)
    rng = np.random.default_rng(16)
    sizes = {(0, 0): 30_000, (0, 1): 9_000, (1, 0): 400, (1, 1): 3, (2, 0): 1, (2, 1): 5_000}
    pdf = pd.concat([pd.DataFrame({"f": f, "o": o, "cmv": rng.normal(size=n)}) for (f, o), n in sizes.items()], ignore_index=True)
    pdf.loc[(pdf.f == 0) & (pdf.o == 1), "cmv"] = pdf.cmv.round(1)  # ties at both percentiles
    pdf.loc[(pdf.f == 2) & (pdf.o == 1), "cmv"] = 7.0  # one value
    df = spark.createDataFrame(pdf)
    got = lines._kept(df, ["f", "o"]).toPandas().set_index(["f", "o"]).sort_index()
    want = plain_limits(pdf).sort_index()
    assert list(got.index) == list(want.index)
    assert (got.c == want["size"]).all() and np.allclose(got.s, want["sum"])
    if margins[0] == 0.003:
        zones = lines._zones(df, ["f", "o"], 0.003)
        assert zones.count() < 2_500 and "Sort [cmv" not in zones._jdf.queryExecution().toString()


def test_cells_with_nan(spark):
    pdf = pd.DataFrame({"f": 0, "o": [0] * 2_000 + [1] * 50, "cmv": [float(i) for i in range(1_000)] + [math.nan] * 1_050})
    got = {r["o"]: r["c"] for r in lines._kept(spark.createDataFrame(pdf).select("f", "o", F.coalesce("cmv", F.lit(math.nan)).alias("cmv")), ["f", "o"]).collect()}
    assert got == {0: 980}  # NaN is largest: the 99th percentile is NaN, the first is 19.99


def quadrants(x, y, xx, yy):
    a = np.mean((xx <= x) & (yy <= y))
    b = np.mean((xx <= x) & ~(yy <= y))
    c = np.mean(~(xx <= x) & (yy <= y))
    return np.array([a, b, c, 1 - a - b - c])


def distance(p, q):
    gaps = np.array([quadrants(x, y, *p) - quadrants(x, y, *q) for x, y in p.T])
    n = p.shape[1]
    gaps[:, 0] -= 1 / n
    return max(-gaps.min(), gaps.max() + 1 / n)


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(13)
    n = 400
    pdf = pd.DataFrame({"k": range(n), "s": np.where(rng.random(n) < 0.4, "a", "b"), "x": rng.integers(0, 12, n).astype(float)})
    pdf["y"] = rng.normal(size=n).round(1) + (pdf.s == "a") * 0.3
    pdf.loc[pdf.k % 3 == 0, "x"] = 5.0  # a third of the points on one line
    pdf.loc[pdf.k % 9 == 0, ["x", "y"]] = [5.0, 0.5]  # and many equal points
    return pdf


@pytest.mark.parametrize("strip", [17, 50_000])
def test_quadrants_and_distances(spark, points, strip):
    df = spark.createDataFrame(points)
    a, b = (points[points.s == s][["x", "y"]].to_numpy().T for s in "ab")
    got = qd.quadrant_counts(df, "s", "x", "y", "a", strip_rows=strip).toPandas()
    assert len(got) == len(points[["x", "y"]].drop_duplicates())
    for r in got.itertuples():
        assert np.allclose([r.a1, r.b1, r.c1, r.d1], quadrants(r.x, r.y, *a))
        assert np.allclose([r.a2, r.b2, r.c2, r.d2], quadrants(r.x, r.y, *b))
    assert np.isclose(qd.maxdist(df, "s", "x", "y", "a", strip).first()[0], distance(a, b))
    d = (distance(a, b) + distance(b, a)) / 2
    row = qd.ks2d(df, "s", "x", "y", "a", strip).first()
    assert np.isclose(row["statistic"], d)
    n1, n2 = a.shape[1], b.shape[1]
    root = math.sqrt(n1 * n2 / (n1 + n2))
    r = math.sqrt(1 - 0.5 * (np.corrcoef(a)[0, 1] ** 2 + np.corrcoef(b)[0, 1] ** 2))
    z = d * root / (1 + r * (0.25 - 0.75 / root))
    tail = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * z * z) for k in range(1, 200))
    assert np.isclose(row["p_value"], tail)


@pytest.mark.parametrize("strip", [17, 50_000])
def test_bootstrap_distances(spark, points, strip):
    df = spark.createDataFrame(points)
    reps, p = qd.bootstrap_distances(df, "s", "x", "y", "a", "k", 5, seed=3, strip_rows=strip)
    got = {r["rep"]: r["statistic"] for r in reps.collect()}
    pool = points.sort_values(["s", "k"])[["x", "y"]].to_numpy()
    n = len(pool)
    draws = spark.range(5 * n).select((F.floor(F.col("id") / n) + 1).cast("int").alias("rep"), (F.col("id") % n).alias("slot"))
    from tabloom.functions.rng import uniform

    picked = draws.withColumn("at", F.floor(uniform(3, "boot", "rep", "slot") * n)).orderBy("rep", "slot").toPandas()
    for rep in range(1, 6):
        xy = pool[picked[picked.rep == rep]["at"].to_numpy()].T
        a, b = xy[:, : p.n1], xy[:, p.n1 :]
        assert np.isclose(got[rep], (distance(a, b) + distance(b, a)) / 2)


def test_kolmogorov_tail_on_both_series(spark):
    d = [0.0, 0.3, 0.8, 0.999, 1.0, 1.5, 3.0]
    got = spark.createDataFrame([(v,) for v in d], "d double").select(qd.kolmogorov_sf(F.col("d")).alias("p")).toPandas().p
    slow = [1.0] + [2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * v * v) for k in range(1, 400)) for v in d[1:]]
    assert np.allclose(got, slow, atol=1e-10)


def numpy_energy(x, y, log):
    def total(a, b, same):
        d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1))
        d = d[np.triu_indices(len(a), 1)] if same else d.ravel()
        return (np.log(d) if log else d).sum()

    n, m = len(x), len(y)
    return total(x, y, False) / (n * m) - total(x, x, True) / n**2 - total(y, y, True) / m**2


@pytest.mark.parametrize("small_blocks", [False, True])
@pytest.mark.parametrize("method", ["log", "linear"])
def test_energy_over_blocks(spark, monkeypatch, method, small_blocks):
    if small_blocks:
        monkeypatch.setattr(en, "BLOCK_BYTES", 1_000)
        monkeypatch.setattr(en, "TILE_CELLS", 64)
    rng = np.random.default_rng(14)
    v = rng.normal(size=(150, 3))
    df = spark.createDataFrame([(i, i % 3 == 0, row.tolist()) for i, row in enumerate(v)], "k int, s boolean, v array<double>")
    s = np.arange(150) % 3 == 0
    got = en.energy(df, "s", "v", "k", True, method).first()
    assert np.isclose(got["energy"], numpy_energy(v[s], v[~s], method == "log")) and got["duplicates"] == 0
    for replace in (False, True):
        if replace and method == "log":
            continue
        reps = en.estat_replicates(df, "s", "v", "k", True, 6, method, replace, seed=5).orderBy("rep").toPandas()
        z = (v - v.mean(0)) / v.std(0)
        assert np.isclose(reps.energy[0], numpy_energy(z[s], z[~s], method == "log"))
        assert len(reps) == 7 and reps.energy.nunique() == 7
    out = en.estat(df, "s", "v", "k", True, nboot=6, method=method, seed=5).first()
    assert 0.0 <= out["p_value"] <= 1.0
    if method == "linear":
        far = df.withColumn("v", F.transform("v", lambda e: e + F.when(F.col("s"), 9.0).otherwise(0.0)))
        assert en.estat(far, "s", "v", "k", True, nboot=6, method=method, replace=True).first()["p_value"] == 0.0


def test_permutations_split_exactly(spark):
    rows = [(i, i < 30, [float(i % 7), float(i)]) for i in range(100)]
    df = spark.createDataFrame(rows, "key int, first boolean, v array<double>")
    got = en._permuted(df, 100, 30, 8, 1).toPandas()
    w = np.stack(got.w1.to_numpy())
    assert (w.sum(axis=0) == 30).all() and w.shape == (100, 9)
    assert len({tuple(c) for c in w.T}) == 9
    drawn = en._resampled(df, 100, 30, 8, 1).toPandas()
    assert (np.stack(drawn.w1.to_numpy())[:, 1:].sum(axis=0) == 30).all()
    assert (np.stack(drawn.w2.to_numpy())[:, 1:].sum(axis=0) == 70).all()


def test_equal_rows_have_no_log_energy(spark):
    df = spark.createDataFrame([(1, 1, [0.0]), (2, 1, [0.0]), (3, 2, [1.0]), (4, 2, [2.0])], "k int, s int, v array<double>")
    row = en.energy(df, "s", "v", "k", 1).first()
    assert row["energy"] is None and row["duplicates"] == 1
    assert np.isclose(en.energy(df, "s", "v", "k", 1, "linear").first()["energy"], numpy_energy(np.zeros((2, 1)), np.array([[1.0], [2.0]]), False))
    with pytest.raises(ValueError):
        en.energy(df, "s", "v", "k", 1, "gaussian")


@pytest.mark.parametrize("parts", [1, 7])
def test_one_dimensional_linear_energy_by_order(spark, monkeypatch, parts):
    monkeypatch.setattr(en, "TILE_CELLS", 64)
    rng = np.random.default_rng(15)
    v = rng.normal(size=(300, 1)).round(1)
    v[::3] = 0.5  # one value that spans partitions
    df = spark.createDataFrame([(i, i % 5 < 2, row.tolist()) for i, row in enumerate(v)], "k int, s boolean, v array<double>").repartition(parts)
    s = np.arange(300) % 5 < 2
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = en.energy(df, "s", "v", "k", True, "linear").first()
        both = []
        for replace in (False, True):
            weighted = (en._resampled if replace else en._permuted)(en._vectors(df, "s", "v", "k", True), 300, 120, 9, 3)
            by_order = en._energies(weighted, 300, 10, 1, 120, 180, "linear").orderBy("rep").toPandas()
            twice = weighted.withColumn("v", F.array(F.col("v")[0], F.lit(0.0)))  # a second, constant axis: by pairs
            both.append((by_order, en._energies(twice, 300, 10, 2, 120, 180, "linear").orderBy("rep").toPandas()))
        plan = en._energies(weighted, 300, 10, 1, 120, 180, "linear")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    equal = np.unique(v, return_counts=True)[1]
    assert np.isclose(got["energy"], numpy_energy(v[s], v[~s], False)) and got["duplicates"] == (equal * (equal - 1) // 2).sum()
    for by_order, by_pairs in both:
        assert len(by_order) == 10 and np.allclose(by_order.energy, by_pairs.energy)
        assert (by_order.duplicates == by_pairs.duplicates).all()
    assert "Generate explode" not in plan  # no row is copied


def test_one_dimensional_linear_energy_of_odd_values(spark):
    rows = [(1, 1, [0.0]), (2, 1, [None]), (3, 2, [1.0]), (4, 2, [float("nan")]), (5, 2, [float("inf")]), (6, 1, [0.0])]
    df = spark.createDataFrame(rows, "k int, s int, v array<double>")
    for v in (F.col("v"), F.array(F.col("v")[0], F.lit(0.0))):  # by order, by pairs
        row = en.energy(df.withColumn("v", v), "s", "v", "k", 1, "linear").first()
        assert row["energy"] is None and row["duplicates"] == 1


def test_wide_rows_by_product(spark, monkeypatch):
    monkeypatch.setattr(en, "TILE_CELLS", 256)
    rng = np.random.default_rng(16)
    v = rng.normal(size=(90, 12)) + 1e6  # far from the origin
    v[1::7] = v[0] + 1e-5 * rng.normal(size=v[1::7].shape)  # close pairs
    v[50] = v[51]
    assert en.PRODUCT_WIDTH <= 12
    with monkeypatch.context() as m:
        w = np.ones((90, 1))
        got = en._pair_sums(v, v, (w, 0 * w), (w, 0 * w), True, True)
        m.setattr(en, "PRODUCT_WIDTH", 99)
        assert np.allclose(got, en._pair_sums(v, v, (w, 0 * w), (w, 0 * w), True, True), rtol=1e-9) and got[3, 0] == 1
        assert np.isnan(en._pair_sums(np.vstack([v, v[:1] * np.nan]), v, (np.ones((91, 1)),) * 2, (w, w), False, False)[0, 0])
    df = spark.createDataFrame([(i, i % 3 == 0, row.tolist()) for i, row in enumerate(v) if i != 50], "k int, s boolean, v array<double>")
    s, kept = np.arange(90) % 3 == 0, np.arange(90) != 50
    for method in ("log", "linear"):
        row = en.energy(df, "s", "v", "k", True, method).first()
        assert np.isclose(row["energy"], numpy_energy(v[s & kept], v[~s & kept], method == "log")) and row["duplicates"] == 0


@pytest.mark.parametrize("method", ["log", "linear"])
def test_energy_in_the_plane_by_cells(spark, monkeypatch, method):
    rng = np.random.default_rng(17)
    v = np.vstack([rng.normal(size=(1500, 2)), 0.01 * rng.normal(size=(1000, 2)) + 5.0, 50.0 * rng.normal(size=(60, 2))])
    v[2000:2040] = v[2000] if method == "linear" else v[2000:2040]  # equal rows
    df = spark.createDataFrame([(i, i % 3 == 0, row.tolist()) for i, row in enumerate(v)], "k int, s boolean, v array<double>")
    pairs = {}
    for replace in (False, True):
        weighted = (en._resampled if replace else en._permuted)(en._vectors(df, "s", "v", "k", True), 2560, 854, 5, 3).localCheckpoint()
        pairs[replace] = weighted, en._energies(weighted, 2560, 6, 2, 854, 1706, method).orderBy("rep").toPandas()
    monkeypatch.setattr(en, "PAIR_ROWS", 1)
    monkeypatch.setattr(en, "CELL_ROWS", 5)  # 68 points a cell, so that most pairs are distant
    monkeypatch.setattr(en, "FAR", [(16.0, 4), (7.0, 7)])
    for weighted, by_pairs in pairs.values():
        by_cells = en._energies(weighted, 2560, 6, 2, 854, 1706, method).orderBy("rep").toPandas()
        assert np.allclose(by_cells.energy.astype(float), by_pairs.energy.astype(float), rtol=0, atol=1e-6, equal_nan=True)
        assert (by_cells.duplicates == by_pairs.duplicates).all()
    bad = weighted.withColumn("v", F.when(F.col("key") == 7, F.array(F.lit(None).cast("double"), F.lit(1.0))).otherwise(F.col("v")))
    assert en._energies(bad, 2560, 6, 2, 854, 1706, method).first()["energy"] is None
