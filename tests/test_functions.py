"""Order, selection, lookup and random helpers."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.functions import lookup as lk
from tabloom.functions import selection as sel
from tabloom.functions.order import ordered, row_index
from tabloom.functions.rng import normals, uniform
from tabloom.operators.missing import special_fit
from tabloom.plans.preprocess import preprocess
from tabloom.sources.roles import Roles


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": rng.permutation(5_000), "w": rng.integers(0, 9, 5_000).astype(float)})
    pdf["v"] = np.where(pdf.k % 3 == 0, 7.0, rng.normal(size=5_000))  # a third of all rows share one value
    return pdf


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_order_does_not_depend_on_partitions(spark, numbers, parts):
    df = spark.createDataFrame(numbers).repartition(parts)
    got = ordered(df, ["v", "k"], {"run": "w"})
    want = numbers.sort_values(["v", "k"]).reset_index(drop=True)
    out = got.df.orderBy("row_no").toPandas()
    assert out.row_no.tolist() == list(range(1, 5_001))
    assert out.k.tolist() == want.k.tolist()
    assert out.run.tolist() == want.w.cumsum().tolist()
    assert got.rows == 5_000 and got.totals["run"] == want.w.sum()


def test_order_of_nothing_and_of_one_row(spark):
    empty = spark.createDataFrame([], "k int")
    assert row_index(empty, ["k"]).count() == 0
    assert row_index(spark.createDataFrame([(5,)], "k int"), ["k"]).first()["row_no"] == 1


@pytest.mark.parametrize("limit", [10, 10_000])
def test_order_statistics_are_exact(spark, numbers, monkeypatch, limit):
    monkeypatch.setattr(sel, "LIST_LIMIT", limit)
    df = spark.createDataFrame(numbers)
    s = np.sort(numbers.v.to_numpy())
    ranks = [1, 2, 1_000, 2_500, 2_501, 3_334, 4_999, 5_000]
    got, extra = sel.order_statistics(df, {"v": F.col("v")}, {"v": ranks}, extra=[F.max("k")])
    assert [p.value for p in got["v"]] == [s[r - 1] for r in ranks] and extra == [4_999]
    assert [(p.less, p.equal) for p in got["v"]] == [((s < s[r - 1]).sum(), (s == s[r - 1]).sum()) for r in ranks]
    with pytest.raises(ValueError):
        sel.order_statistics(df, {"v": F.col("v")}, {"v": [5_001]})


def test_order_statistics_between_two_heavy_values(spark, monkeypatch):
    monkeypatch.setattr(sel, "LIST_LIMIT", 10)
    df = spark.range(1_000).select(F.when(F.col("id") < 500, 1.0).otherwise(2.0).alias("v"))
    got, _ = sel.order_statistics(df, {"v": F.col("v")}, {"v": [499, 500, 501, 502]})
    assert [p.value for p in got["v"]] == [1.0, 1.0, 2.0, 2.0]


def test_quantiles_match_numpy_on_both_paths(spark, numbers, monkeypatch):
    df = spark.createDataFrame(numbers)
    q = [0.0, 0.01, 0.5, 0.99, 1.0]
    want = np.quantile(numbers.v, q)
    rest = np.quantile(numbers.v[numbers.v != 7.0], q)
    hot = sel.Place(7.0, int((numbers.v < 7.0).sum()), int((numbers.v == 7.0).sum()))
    for limit in (10_000, 100, 5):
        monkeypatch.setattr(sel, "LIST_LIMIT", limit)
        args = df, {"v": F.col("v"), "none": F.lit(None).cast("double")}, q, {"v": 5_000, "none": 0}
        got, _ = sel.exact_quantiles(*args)
        assert np.allclose(got["v"], want, rtol=0, atol=1e-12)
        assert got["none"] == [None] * 5
        got, _ = sel.exact_quantiles(*args, without={"v": hot})
        assert np.allclose(got["v"], rest, rtol=0, atol=1e-12)


@pytest.mark.parametrize("key_type", ["long", "string"])
@pytest.mark.parametrize("k", [0, 1, 1_700, 4_000, 5_000, 9_000])
def test_smallest_takes_exactly_k_with_ties_by_key(spark, numbers, key_type, k):
    df = spark.createDataFrame(numbers).withColumn("k", F.lpad(F.col("k").cast("string"), 5, "0") if key_type == "string" else F.col("k"))
    keep = sel.smallest(df, {"v": (F.col("v"), k)}, "k", 5_000)["v"]
    got = {int(r["k"]) for r in df.where(keep).select("k").collect()}
    assert got == set(numbers.sort_values(["v", "k"]).k.head(k))


def test_lookup_keeps_every_row_when_one_key_is_hot(spark, monkeypatch):
    rows = [(i, "hot" if i % 3 else f"k{i}") for i in range(3_000)] + [(9_000, None)]
    df = spark.createDataFrame(rows, "id int, key string")
    table = df.where("key is not null").groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    want = sorted(map(tuple, lk.lookup(df, table, ["key"], "n").fillna(-1, ["top"]).fillna("", ["key"]).collect()))
    monkeypatch.setattr(lk, "BROADCAST_ROWS", 0)
    got = sorted(map(tuple, lk.lookup(df, table, ["key"], "n").fillna(-1, ["top"]).fillna("", ["key"]).collect()))
    assert got == want and len(got) == 3_001


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_random_columns_have_the_right_shape(spark, method):
    df = spark.range(20_000).select(uniform(1, "s", "id", method=method).alias("u"), *[n.alias(f"n{i}") for i, n in enumerate(normals(3, 1, "z", "id", method=method))])
    pdf = df.toPandas()
    assert 0 < pdf.u.min() and pdf.u.max() < 1 and abs(pdf.u.mean() - 0.5) < 0.01
    z = pdf[["n0", "n1", "n2"]]
    assert np.allclose(z.mean(), 0, atol=0.03) and np.allclose(z.std(), 1, atol=0.03)
    assert np.abs(np.corrcoef(z.T.to_numpy()) - np.eye(3)).max() < 0.03


def test_task_functions_need_no_package_on_the_executors(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from tabloom.operators import energy, quadrants

    (tmp_path / "f").write_bytes(cloudpickle.dumps([quadrants._in_x_strip, quadrants._cells_below, energy._block_sums(True)]))
    code = "from pyspark import cloudpickle; fs = cloudpickle.load(open('f', 'rb')); import sys; assert len(fs) == 3 and 'tabloom' not in sys.modules"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=60)


def test_profile_merges_sketches_of_many_partitions_in_two_levels(spark):
    df = spark.range(0, 100_000, 1, 2000).select(
        F.when(F.col("id") % 10 != 0, (F.col("id") * 7919 % 100_003).cast("double")).alias("x"), (F.col("id") + (1 << 60)).alias("big")
    )
    known = sel.profile(df, {"x": F.col("x"), "big": F.col("big"), "none": F.lit(None).cast("double")})
    x = np.array([i * 7919 % 100_003 for i in range(100_000) if i % 10])
    assert (known.rows, known.count) == (100_000, {"x": 90_000, "big": 100_000, "none": 0})
    assert (known.low["x"], known.high["x"], known.low["none"], known.std["none"], known.grids["none"]) == (x.min(), x.max(), None, None, [])
    assert known.mean["x"] == pytest.approx(x.mean(), rel=1e-12) and known.std["x"] == pytest.approx(x.std(ddof=1), rel=1e-12)
    ranks = {n: [(v <= q).mean() - p for p, q in known.grids[n]] for n, v in (("x", x), ("big", np.arange(100_000) + (1 << 60)))}
    assert all(abs(r) < sel._MARGIN for some in ranks.values() for r in some)
    assert known.low["big"] == 1 << 60 and all(isinstance(q, int) for _, q in known.grids["big"])
    middle, _ = sel.medians(df, {"x": F.col("x"), "big": F.col("big")}, known.count, known.grids)
    assert middle == {"x": float(np.median(x)), "big": float((1 << 60) + 49_999)}


def test_no_sketch_of_a_fit_goes_straight_to_one_task(spark, monkeypatch):
    plans = []
    frame = type(spark.range(1))
    first = frame.first
    monkeypatch.setattr(frame, "first", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), first(df))[1])
    df = spark.range(50_000).select("id", (F.col("id") % 977 + 1).cast("double").alias("v"))
    special_fit(df, ["v"])
    assert any("kll_merge" in p and "kll_sketch_agg" in p for p in plans)
    assert not any("percentile_approx" in p or "approx_percentile" in p for p in plans)


def test_the_fits_of_the_main_job_share_their_scans(spark, monkeypatch):
    rows = [(i, "ab"[i % 2], float(i % 997) ** 1.5 + 1, float(i % 50), i % 3) for i in range(6_000)]
    df = spark.createDataFrame(rows, "id long, g string, x double, y double, t int").cache()
    df.count()
    scans = []
    frame = type(df)
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda df: (scans.append(1), collect(df))[1])  # `first` collects too
    preprocess(df, Roles({"id": "K", "g": "C", "x": "N", "y": "N", "t": "L"}), resolution=0.01)
    assert len(scans) <= 5  # categories, profile, medians, logarithms with variances, scaling


def test_running_sums_take_no_shuffle_beyond_the_sort(spark):
    df = spark.createDataFrame([(i, float(i % 7) if i % 5 else None, "x") for i in range(5_000)], "k int, v double, `a.b` string").repartition(9)
    done = ordered(df, [F.desc("k")], {"total": "v", "n": F.lit(1)})
    plan = done.df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan and "SinglePartition" not in plan
    got = done.df.orderBy("row_no").toPandas()
    v = np.array([i % 7 if i % 5 else 0 for i in range(4_999, -1, -1)])
    assert list(got.columns) == ["k", "v", "a.b", "row_no", "total", "n"] and list(got.k) == list(range(4_999, -1, -1))
    assert (got.total == v.cumsum()).all() and (got.n == got.row_no).all() and done.totals == {"total": v.sum(), "n": 5_000}
    empty = ordered(df.limit(0), ["k"], {"total": "v"})
    assert (empty.rows, empty.totals, empty.df.count()) == (0, {"total": 0}, 0)
