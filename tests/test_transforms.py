"""Encoders, flags, imputation and numeric transforms against numpy and on edge rows."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import boxcox as bc
from tabloom.operators import impute, likelihood, missing, moments, onehot, scaler, splits, target


def column(df, name, key="k"):
    return [r[name] for r in df.orderBy(key).collect()]


def test_onehot_round_trip_order_and_types(spark):
    df = spark.createDataFrame([(1, "b", "1"), (2, "a", "0"), (3, None, "1"), (4, "b", "0")], "k int, c string, f string")
    out, names, stats = onehot.onehot_fit_transform(df, ["c", "f"], "k")
    assert stats.columns["c"] == {"values": ["b", "a", "null"], "type": "categorical"}
    assert stats.columns["f"]["type"] == "indicator"
    assert names == ["c_a", "c_b", "c_null", "f"]
    assert column(out, "f") == [0.5, -0.5, 0.5, -0.5]
    assert column(onehot.onehot_back(out, stats), "c") == ["b", "a", "", "b"]
    assert column(onehot.onehot_back(out, stats, restore_indicators=True), "f") == ["1", "0", "1", "0"]
    unseen = spark.createDataFrame([(1, "zz", "0")], "k int, c string, f string")
    row = onehot.onehot_transform(unseen, stats)[0].first()
    assert row["c_a"] == row["c_b"] == row["c_null"] == -0.5
    # an unseen category ties everywhere: the first value seen wins
    assert onehot.onehot_back(onehot.onehot_transform(unseen, stats)[0], stats).first()["c"] == "b"
    with pytest.raises(ValueError):
        onehot.onehot_back(out, stats, drop_first=True)
    assert "c_a" not in onehot.onehot_transform(df, stats, drop_first=True)[0].columns
    assert "c" in onehot.onehot_transform(df, stats, remove_original=False)[0].columns
    with pytest.raises(ValueError):
        onehot.onehot_fit(df, ["c"], "k", max_values=2)


def test_likelihood_formula_and_storage(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 0.0), (3, "b", 1.0), (4, None, 1.0)], "k int, c string, y double")
    out, stats = likelihood.laplace_fit_transform(df, "y", ["c"])
    avg = 0.75
    assert np.allclose(column(out, "c"), [(1 + 30 * avg) / 32] * 2 + [(1 + 30 * avg) / 31, avg])
    likelihood.save_likelihoods(stats, str(tmp_path / "l"))
    again = likelihood.load_likelihoods(spark, str(tmp_path / "l"))
    assert column(likelihood.laplace_transform(df, again, ["c", "k"]), "c") == column(out, "c")
    assert "c_likeli" in likelihood.laplace_transform(df, stats, ["c"], replace=False).columns


def test_target_truncates(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0)], "k int, y double")
    assert column(target.center_target(df, ["y"]), "y") == [-0.5, 0.5]
    made = spark.createDataFrame([(1, -1.7), (2, 0.49), (3, 0.5), (4, -0.2)], "k int, y double")
    assert column(target.uncenter_target(made, ["y"]), "y") == [-1, 0, 1, 0]


@pytest.mark.parametrize("nulls,flag", [(2, False), (3, True)])
def test_missing_flag_needs_more_than_its_share(spark, nulls, flag):
    df = spark.range(1_000).select(F.col("id").alias("k"), F.when(F.col("id") >= nulls, F.col("id") * 1.0).alias("v"))
    out, flags, stats = missing.missing_fit_transform(df, ["v"])
    assert flags == (["v_missing"] if flag else [])
    assert stats.columns["v"]["nmissing"] == nulls / 1_000
    assert stats.columns["v"]["median"] == np.median(np.arange(nulls, 1_000))
    if flag:
        back = missing.missing_back(impute.impute_zero(out, ["v"]), stats, "k")
        assert column(back, "v")[: nulls + 1] == [None] * nulls + [float(nulls)]


@pytest.mark.parametrize("frequencies", ["all", "majority"])
@pytest.mark.parametrize("heavy,distinct,flag", [(501, 499, True), (500, 500, False), (900, 30, True), (900, 29, False)])
def test_high_frequency_limits(spark, frequencies, heavy, distinct, flag):
    """`distinct` further values: 30 of them with the heavy one make 31."""
    values = [0.0] * heavy + [1.0 + i % distinct for i in range(1_000 - heavy)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, v double")
    out, _, frequent, stats = missing.special_fit_transform(df, ["v"], frequencies)
    assert frequent == (["v_highfreq"] if flag else [])
    rest = [v for v in values if v != 0.0] if flag else values
    assert stats.columns["v"]["median"] == np.median(rest)
    if flag:
        assert out.where("v is null").count() == heavy
        back = missing.special_back(impute.impute_zero(out, ["v"]).withColumn("v", F.col("v") + 5), stats, "k")
        assert column(back, "v") == [0.0] * heavy + [v + 5 for v in values[heavy:]]


def test_special_back_missing_overrides_and_counts(spark):
    stats = missing.ColumnStats("special", {"v": {"nmissing": 0.25, "nhighfreq": 0.5, "highfreq": 9.0, "missing_column": "m", "highfreq_column": "h"}})
    df = spark.createDataFrame([(i, float(i), 0.5 - (i == 7) * 1.0, i / 10) for i in range(8)], "k int, v double, m double, h double")
    # round(.5 * (8 - .25)) = 4 frequent rows by h, round(.25 * 8) = 2 missing rows by (m, key)
    assert column(missing.special_back(df, stats, "k"), "v") == [None, 9.0, 9.0, 9.0, 4.0, 5.0, 6.0, None]
    # exact counts: round(.5 * 8 * .75) = 3
    assert column(missing.special_back(df, stats, "k", exact_counts=True), "v") == [None, 9.0, 9.0, 3.0, 4.0, 5.0, 6.0, None]
    # without the frequency flag the missing rows still come back
    assert column(missing.special_back(df.drop("h"), stats, "k"), "v")[0] is None


def test_empty_and_constant_columns(spark):
    df = spark.createDataFrame([(i, None, 3.0, 0.1) for i in range(5)], "k int, e double, c double, d double")
    stats = missing.special_fit(df, ["e", "c"])
    assert stats.columns["e"]["median"] is None and stats.columns["e"]["nmissing"] == 1.0
    scaled, s = scaler.scaler_fit_transform(df, ["e", "c", "d"])
    assert s.columns["c"]["scaling_type"] == s.columns["d"]["scaling_type"] == "constant"
    assert column(scaled, "c") == [0.0] * 5 and column(scaled, "e") == [None] * 5
    assert column(scaler.scaler_back(scaled, s), "c") == [3.0] * 5
    boxed, b = bc.boxcox_fit_transform(df, ["e", "c"])
    assert b.columns["c"]["lambd"] is None and column(boxed, "c") == [3.0] * 5
    assert column(bc.boxcox_back(boxed, b), "c") == [3.0] * 5
    assert column(impute.impute_median(df, ["e", "c"]), "e") == [None] * 5
    assert impute.impute_random(df, ["e"], "k").count() == 5


def log_likelihood(x, lam):
    y = np.log(x) if lam == 0 else (x**lam - 1) / lam
    return (lam - 1) * np.log(x).sum() - len(x) / 2 * np.log(y.var())


@pytest.mark.parametrize("power", [0.5, -1.5, 4.0])
def test_boxcox_lambda_maximises_the_likelihood(spark, power):
    z = np.abs(np.random.default_rng(5).normal(10, 2, 4_000)) + 0.5
    x = z ** (1 / power)
    df = spark.createDataFrame(pd.DataFrame({"k": range(len(x)), "v": x}))
    lam = bc.boxcox_fit(df, ["v"]).columns["v"]["lambd"]
    near = [log_likelihood(x, lam + d) for d in (-1e-3, 0.0, 1e-3)]
    assert near[1] > near[0] and near[1] > near[2]
    # the slope of the likelihood is zero to about 1e-5 in lambda
    a, b, c = near
    assert abs(0.5 * 1e-3 * (a - c) / (a - 2 * b + c)) < 2e-5
    step = bc.boxcox_fit(df, ["v"], resolution=0.01).columns["v"]["lambd"]
    grid = [round(g, 2) for g in np.arange(lam - 0.1, lam + 0.1, 0.01)]
    assert step == max(grid, key=lambda g: log_likelihood(x, g))


def test_boxcox_round_trip_shift_and_clip(spark):
    x = np.concatenate([np.random.default_rng(2).gamma(2.0, 3.0, 500) - 4.0])
    df = spark.createDataFrame(pd.DataFrame({"k": range(500), "v": x}))
    out, stats = bc.boxcox_fit_transform(df, ["v"])
    assert stats.columns["v"]["shift"] == 1.0 - x.min()
    assert np.allclose(column(bc.boxcox_back(out, stats), "v"), x)
    far = out.withColumn("v", F.lit(1e9))
    assert column(bc.boxcox_back(far, stats), "v")[0] == x.max()
    below = df.withColumn("v", F.lit(float(x.min() - 2)))
    assert column(bc.boxcox_transform(below, stats), "v")[0] is None
    stats.columns["v"]["lambd"] = 0.0  # as a reviewer may set it
    assert np.allclose(column(bc.boxcox_transform(df, stats), "v"), np.log(x + stats.columns["v"]["shift"]))
    assert np.allclose(column(bc.boxcox_back(bc.boxcox_transform(df, stats), stats), "v"), x)
    stats.columns["v"]["lambd"] = 0.5
    no_root = df.withColumn("v", F.lit(-100.0)).withColumn("k", F.col("k"))
    stats.columns["v"]["lambd"] = 0.3
    assert column(bc.boxcox_back(no_root, stats), "v")[0] is None


def test_boxcox_histograms_match_numpy(spark):
    x = np.random.default_rng(3).gamma(2.0, 3.0, 2_000)
    df = spark.createDataFrame(pd.DataFrame({"k": range(2_000), "v": x}))
    stats = bc.boxcox_fit(df, ["v"])
    got = bc.boxcox_hist(df, stats).toPandas()
    lam = stats.columns["v"]["lambd"]
    for kind, values in (("original", x), ("log", np.log(x)), ("boxcox", (x**lam - 1) / lam)):
        part = got[got.kind == kind].set_index("bin").n
        assert part.reindex(range(30), fill_value=0).tolist() == np.histogram(values, bins=30)[0].tolist()


def test_scaler_against_numpy(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"k": range(400), "n": rng.normal(size=400), "m": np.where(np.arange(400) == 7, 60.0, rng.normal(size=400))})
    out, stats = scaler.scaler_fit_transform(spark.createDataFrame(pdf), ["n", "m"])
    assert [stats.columns[c]["scaling_type"] for c in "nm"] == ["normal", "minmax"]
    assert np.allclose(column(out, "n"), (pdf.n - pdf.n.mean()) / pdf.n.std())
    assert np.allclose(column(out, "m"), (2 * pdf.m - (pdf.m.max() + pdf.m.min())) / (pdf.m.max() - pdf.m.min()))
    back = scaler.scaler_back(out, stats)
    assert np.allclose(column(back, "n"), pdf.n) and np.allclose(column(back, "m"), pdf.m)
    for c in "nm":
        assert math.isclose(scaler.scaled_median(stats.columns[c]), float(np.median(column(out, c))), abs_tol=1e-12)


DUMP = [
    "0:[f0<0.5] yes=1,no=2,missing=1,gain=40.5,cover=16",
    "1:[f2<-1e-3] yes=3,no=4,missing=3,gain=8,cover=9",
    "0:[f0<2.5] yes=1,no=2,missing=1,gain=10,cover=16",
    "0:[f1<7] yes=1,no=2,missing=1,gain=3,cover=4",
    "2:leaf=0.25,cover=3",
]


def test_splits_from_dump_text(spark):
    dump = spark.createDataFrame([(t,) for t in DUMP], "value string")
    stats = splits.splitcap_fit(dump, ["a", "b", "c"], ["a", "b", "c"])
    assert stats.columns == {
        "a": {"min_split": 0.5, "max_split": 2.5}, "b": {"min_split": 7.0, "max_split": 7.0}, "c": {"min_split": -0.001, "max_split": -0.001},
    }
    df = spark.createDataFrame([(1, 0.0, 6.0, -0.001), (2, 1.0, 7.0, 0.0), (3, 2.5, 8.0, -5.0), (4, 9.0, 7.5, None)], "k int, a double, b double, c double")
    out, _ = splits.splitcap_fit_transform(df, dump, ["a", "b", "c"])
    assert column(out, "a") == [-2.0, -0.5, 1.0, 2.0]
    assert column(out, "b") == [-1.0, 0.0, 1.0, 1.0]
    assert column(out, "c") == [0.0, 1.0, -1.0, None]
    assert column(splits.splitcap_back(out, stats), "a") == [-0.5, 1.0, 2.5, 3.5]
    got = [tuple(r) for r in splits.tree_importance(dump, ["a", "b", "c"]).collect()]
    assert got == [("a", 25.25), ("c", 8.0), ("b", 3.0)]


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_random_imputation_draws_observed_values(spark, parts):
    rows = [(i, None if i % 3 else float(i), 1.0) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, v double, w double").repartition(parts)
    got = column(impute.impute_random(df, ["v", "w"], "k", seed=3), "v")
    assert all(g == i if i % 3 == 0 else g % 3 == 0 for i, g in enumerate(got))
    assert len(set(got[1::3])) > 50
    assert got == column(impute.impute_random(df.repartition(2), ["v", "w"], "k", seed=3), "v")


def test_model_imputation_follows_the_features(spark):
    pdf = pd.DataFrame({"k": range(400), "x": [float(i % 20) for i in range(400)]})
    pdf["v"] = [None if i % 7 == 0 else 10.0 * (x > 9) for i, x in enumerate(pdf.x)]
    rows = [(k, x, None if np.isnan(v) else v) for k, x, v in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "k long, x double, v double")
    out = impute.impute_model(df, ["v"], ["x", "v"], maxIter=10, stepSize=0.5)
    assert out.columns == ["k", "x", "v"]
    got = out.orderBy("k").toPandas()
    assert (got.v[pdf.v.notna()] == pdf.v[pdf.v.notna()]).all()
    assert (abs(got.v - 10.0 * (got.x > 9)) < 2).all()


def test_svd_scores_match_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 14)) @ rng.normal(size=(14, 14)) + 1.0
    cols = [f"c{i}" for i in range(14)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=cols).assign(k=range(300)))
    got = moments.svd_standardize(df, cols, 5).orderBy("k").toPandas()[[f"svd_{i}" for i in range(5)]].to_numpy()
    v = np.linalg.svd(x, full_matrices=False)[2][:5].T
    v *= np.sign(v[np.abs(v).argmax(axis=0), range(5)])
    s = x @ v
    assert np.allclose(got, (s - s.mean(0)) / s.std(0), atol=1e-6)
    plain = moments.svd_standardize(df, cols, 0).orderBy("k").toPandas()[cols].to_numpy()
    assert np.allclose(plain, (x - x.mean(0)) / x.std(0))


def test_row_local_transforms_run_on_a_stream(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i) if i % 4 else None, "ab"[i % 2]) for i in range(40)], "k int, v double, c string")
    _, _, oh = onehot.onehot_fit_transform(df, ["c"], "k")
    _, _, _, sp = missing.special_fit_transform(df, ["v"])
    b = bc.boxcox_fit(df, ["v"])
    s = scaler.scaler_fit(bc.boxcox_transform(df, b), ["v"])

    def run(t):
        t = onehot.onehot_transform(t, oh)[0]
        t = missing.special_transform(t, sp)[0]
        return scaler.scaler_transform(bc.boxcox_transform(t, b), s)

    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = run(stream).writeStream.format("memory").queryName("scaled_stream").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = sorted(map(str, spark.table("scaled_stream").collect()))
    assert got == sorted(map(str, run(df).collect())) and len(got) == 40


@pytest.mark.parametrize("limit", [100_000, 1])
def test_vocabulary_as_a_table(spark, monkeypatch, limit):
    from tabloom.functions import lookup

    monkeypatch.setattr(lookup, "BROADCAST_ROWS", limit)
    rows = [(3, "b", "7"), (1, "a", None), (2, None, "7"), (5, "b", "0"), (4, "b", "x"), (6, "", "null")]
    df = spark.createDataFrame(rows, "k int, `c.1` string, f string")
    cols = ["c.1", "f"]
    v = onehot.onehot_vocabulary(df, cols, "k")
    fitted = onehot.onehot_fit(df, cols, "k").columns
    for c in cols:
        own = v.where(F.col("col") == c).orderBy("position").collect()
        assert [r["value"] for r in own] == fitted[c]["values"] and [r["position"] for r in own] == list(range(len(own)))
    done = onehot.onehot_index(df, v, cols)
    assert done.columns == ["k", "c.1_index", "f_index"]
    for r in done.collect():
        c, f = next(("null" if x is None else x, "null" if y is None else y) for k, x, y in rows if k == r["k"])
        assert (fitted["c.1"]["values"][r["c.1_index"]], fitted["f"]["values"][r["f_index"]]) == (c, f)
    back = {r["k"]: (r["c.1"], r["f"]) for r in onehot.onehot_index_back(done, v, cols).collect()}
    assert back[1] == ("a", "") and back[2] == ("", "7") and back[6] == ("", "")
    unseen = spark.createDataFrame([(1, "q", "7")], "k int, `c.1` string, f string")
    row = onehot.onehot_index(unseen, v, cols).first()
    assert row["c.1_index"] is None and row["f_index"] is not None
    assert onehot.onehot_index_back(onehot.onehot_index(unseen, v, cols), v, cols).first()["c.1"] is None
    with pytest.raises(ValueError):
        onehot.onehot_index(df.withColumn("f_index", F.lit(0)), v, ["f"])


def test_a_million_categories_stay_in_tasks(spark):
    df = spark.range(1_000_000).select("id", F.concat(F.lit("v"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string")).alias("c"))
    v = onehot.onehot_vocabulary(df, ["c"], "id")
    assert v.agg(F.count("*"), F.max("position"), F.max("n")).first() == (666_667, 666_666, 333_334)
    assert onehot.onehot_index(df, v, ["c"]).agg(F.count("c_index"), F.count_distinct("c_index")).first() == (1_000_000, 666_667)
    with pytest.raises(ValueError, match="onehot_vocabulary"):
        onehot.onehot_fit(df, ["c"], "id")
