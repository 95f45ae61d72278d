"""The same answer whatever the size, odd column names, and input that leaves a measure undefined."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import boxcox, energy, likelihood, missing, moments, network, onehot, quadrants, ranking
from tabloom.plans.postprocess import postprocess
from tabloom.plans.preprocess import preprocess
from tabloom.sources.roles import Roles


def _net(width, seed=1):
    r = np.random.default_rng(seed)
    return network.Network(
        [
            network.Layer("a", "dense", weight=r.normal(size=(width, 5)), bias=r.normal(size=5)),
            network.Layer("b", "relu"),
            network.Layer("c", "dense", weight=r.normal(size=(5, 2)), bias=r.normal(size=2)),
            network.Layer("d", "sigmoid"),
        ]
    )


@pytest.mark.parametrize("key", ["k", None])
def test_forms_of_the_forward_pass_agree_on_missing_inputs(spark, key):
    rows = [(1, 0.5, 1.0), (2, None, 1.0), (3, float("nan"), 2.0), (4, -3.0, None), (5, 1e3, -1e3), (6, None, None)]
    df = spark.createDataFrame(rows, "k long, `x.1` double, y double")
    got = {}
    for how in ("expression", "batches", "relational"):
        out = network.dense_forward(df, _net(2), ["x.1", "y"], ["p", "q"], how=how, key=key)
        got[how] = {r.k: (r.p, r.q) for r in out.collect()}
        assert [k for k, v in sorted(got[how].items()) if v == (None, None)] == [2, 3, 4, 6]
    for how in ("batches", "relational"):
        for k in (1, 5):
            assert np.allclose(got[how][k], got["expression"][k])


def test_weights_table_holds_every_weight(spark):
    net = _net(3)
    config = {"a": {"type": "dense", "previous": "input"}, "b": {"type": "relu", "previous": "a"}, "c": {"type": "dense", "previous": "b"}, "d": {"type": "sigmoid", "previous": "c"}}
    back = network.Network.from_frame(config, net.weights_frame(spark))
    assert all(np.array_equal(x.weight, y.weight) and np.array_equal(x.bias, y.bias) for x, y in zip(net.dense, back.dense))


@pytest.mark.parametrize("width", [3, 12, 13, 20])
def test_moments_leave_incomplete_rows_out(spark, width):
    x = np.random.default_rng(2).normal(size=(40, width))
    rows = [[float(v) for v in r] for r in x]
    rows[3][1], rows[7][2] = None, float("nan")
    names = [f"c.{i}" for i in range(width)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names))
    full = np.delete(x, [3, 7], axis=0)
    assert np.allclose(moments.cross_moments(df, [F.col(f"`{n}`") for n in names]), full.T @ full)
    net = moments.fit_generator(df, names[1:], names[:1])
    own = moments.fit_generator(df.where(network.complete(names)), names[1:], names[:1])
    assert np.allclose(net.dense[0].weight, own.dense[0].weight) and np.allclose(net.dense[0].bias, own.dense[0].bias)
    assert moments.fit_generator(df.limit(0), names[1:], names[:1]).dense[0].weight.any() == False  # noqa: E712


def test_categories_with_any_characters_survive_the_whole_job(spark):
    values = ["1.0", "2.0", "a.b", "x`y", "with space", "Inc."]
    rows = [(i, values[i % len(values)], float(i) ** 1.5, i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, `g.h` string, `n m` double, t int")
    header = Roles({"id": "K", "g.h": "C", "n m": "N", "t": "L"})
    done = preprocess(df, header)
    back = postprocess(done.table, header, done.stats, "id")
    got = {r["id"]: (r["g.h"], r["n m"]) for r in back.collect()}
    assert all(got[i][0] == g and got[i][1] == pytest.approx(n, rel=1e-6, abs=1e-6) for i, g, n, _ in rows)


def test_many_categories_are_refused_only_on_request(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(30)], "k long, g string")
    assert len(onehot.onehot_fit(df, ["g"], "k").columns["g"]["values"]) == 30
    with pytest.raises(ValueError):
        onehot.onehot_fit(df, ["g"], "k", max_values=29)


@pytest.mark.parametrize("shape", ["plus", "minus", "lognormal"])
def test_boxcox_search_takes_few_scans(spark, shape, monkeypatch):
    r = np.random.default_rng(3)
    x = {"plus": 1000 + r.exponential(1, 4000), "minus": 1000 - r.exponential(1, 4000), "lognormal": np.exp(r.normal(size=4000))}[shape]
    scans = []
    run = boxcox._variances
    monkeypatch.setattr(boxcox, "_variances", lambda df, wanted: scans.append(1) or run(df, wanted))
    df = spark.createDataFrame([(float(v),) for v in x], "v double").cache()
    lam = boxcox.boxcox_fit(df, ["v"]).columns["v"]["lambd"]
    z = np.log(x) - np.log(x).mean()
    score = lambda s: np.log(np.var(np.expm1(s * z) / s))
    fine = lam + np.linspace(-0.5, 0.5, 2001) * max(1.0, abs(lam) / 100)
    assert len(scans) <= 10 and abs(min(fine, key=score) - lam) <= 1e-3 * max(1.0, abs(lam))


KINDS = {"empty": [], "null": [(i, None, None, "a" if i % 2 else "b") for i in range(6)], "constant": [(i, 1.0, 1.0, "a" if i % 2 else "b") for i in range(6)], "zero": [(i, 0.0, float(i), "a") for i in range(6)]}


@pytest.mark.parametrize("kind", KINDS)
def test_undefined_measures_are_null(spark, kind):
    df = spark.createDataFrame(KINDS[kind], "k long, y double, p double, s string")
    value = lambda out: out.first()[0]
    assert value(ranking.gini(df, "y", "p", "k")) is None
    if kind != "constant":
        assert value(ranking.capture_rate(df, "y", "p", "k")) is None
    ranking.accuracy_index(df, "y", "p", "k").collect()
    missing.missing_fit(df, ["y"])
    likelihood.laplace_fit(df, "y", ["s"])
    stats = boxcox.boxcox_fit(df, ["y"])
    boxcox.boxcox_hist(df, stats).collect()
    if kind == "constant":
        assert energy.estat(df, "s", ["y", "p"], "k", "a", nboot=3, replace=True).first().p_value is None
        assert quadrants.ks2d(df, "s", "y", "p", "a").first().p_value is None


def test_histogram_keeps_every_value(spark):
    df = spark.createDataFrame([(v,) for v in (-5.0, 0.0, 0.4, 1.0, 9.0, None, float("nan"))], "v double")
    got = {r.bin: r.n for r in ranking.histogram(df, F.col("v"), 0.0, 1.0, 2).collect()}
    assert got == {0: 3, 1: 2}


def test_any_column_name_survives_the_whole_job(spark):
    rows = [(i, "ab"[i % 2], float(i) ** 1.5 + 1, 5.0 if i % 4 else float(i), None if i % 7 == 0 else float(i % 50), float(i % 3)) for i in range(400)]
    names = ["i.d", "g.h", "x.1", "y`2", "z.`3.", "t.0"]
    df = spark.createDataFrame(rows, "a long, b string, c double, d double, e double, f double").toDF(*names)
    header = Roles(dict(zip(names, "KCNNNL")))
    done = preprocess(df, header)
    assert {f"{n}_{k}" for n, k in (("y`2", "highfreq"), ("z.`3.", "missing"))} <= set(done.table.columns)
    back = postprocess(done.table, header, done.stats, "i.d").toPandas()
    assert list(back["x.1"]) == pytest.approx([r[2] for r in rows], rel=1e-6, abs=1e-6)
    assert back["z.`3."].isna().sum() == sum(r[4] is None for r in rows)
    logs = boxcox.ColumnStats("boxcox", {"x.1": {"median": 1.0, "min": 1.0, "max": 9000.0, "std": 1.0, "shift": 0.0, "lambd": 0.0}})
    there = boxcox.boxcox_back(boxcox.boxcox_transform(df, logs), logs).select("`x.1`").toPandas()["x.1"]
    assert list(there) == pytest.approx([r[2] for r in rows])
    assert moments.svd_standardize(df, ["x.1", "y`2"], 0).count() == 400
