"""Headers, files, logs, batches and the three whole jobs."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from suite.fixtures import HEADER, TRAIN, tiny_net, view
from tabloom.plans.generate import choose_iteration, generate
from tabloom.plans.postprocess import postprocess
from tabloom.plans.preprocess import preprocess, read_stats, write_preprocessed
from tabloom.sources import roles as rl
from tabloom.sources import tables, training_log
from tabloom.sources.stats import ColumnStats, load_stats, save_stats

SF = "/root/testdata/sf0.001"


def test_role_header_and_typed_csv(spark, tmp_path):
    (tmp_path / "h.csv").write_text("id,amount,kind,y,extra\nK,N,C,L,\n,-1,none,,\n")
    (tmp_path / "t.csv").write_text("kind,id,amount,y,extra\na,007,1.5,1,q\nnone,008,-1,0,\nb,009,,1,q\nc,010,NaN,1,q\n")
    header = rl.read_role_header(spark, str(tmp_path / "h.csv"))
    assert (header.key, header.numerical, header.categorical, header.targets) == ("id", ["amount"], ["kind"], ["y"])
    df = rl.read_typed_table(spark, str(tmp_path / "t.csv"), header)
    assert dict(df.dtypes) == {"id": "string", "amount": "double", "kind": "string", "y": "double", "extra": "string"}
    rows = df.orderBy("id").collect()
    assert [r["id"] for r in rows] == ["007", "008", "009", "010"]
    assert [r["amount"] for r in rows] == [1.5, None, None, None]  # marker, empty and NaN are all missing
    assert [r["kind"] for r in rows] == ["a", None, "b", "c"]
    scaled = rl.derive_scaled_roles(["id", "amount", "kind_a", "amount_missing", "y"], ["amount"], ["kind_a"], ["amount_missing"], [], ["y"])
    rl.write_role_header(spark, scaled, str(tmp_path / "hs"))
    assert rl.read_role_header(spark, str(tmp_path / "hs")).roles == {"id": "", "amount": "N", "kind_a": "G", "amount_missing": "G", "y": "G"}
    assert rl.network_columns(scaled, True) == (["amount"], ["kind_a", "amount_missing", "y"])
    assert rl.network_columns(scaled, False) == (["amount", "kind_a", "amount_missing", "y"], [])


def test_stats_files_keep_numbers_and_order(spark, tmp_path):
    stats = ColumnStats("x", {"b": {"v": 0.1 + 0.2, "n": None, "l": ["q", "0"]}, "a": {}})
    save_stats(spark, stats, str(tmp_path / "s"))
    again = load_stats(spark, str(tmp_path / "s"))
    assert again == stats and list(again.columns) == ["b", "a"]


def test_columns_are_pruned_in_the_scan(spark):
    df = tables.read_columns(spark, f"{SF}/lineitem.parquet", ["l_tax", "l_quantity"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in plan


@pytest.mark.parametrize("parts", [1, 17])
@pytest.mark.parametrize("rows,batch,chunk,coverage", [(1_000, 50, 300, 2), (1_000, 300, 300, 3), (40, 50, 100, 1), (130, 1, 2, 1)])
def test_minibatches(spark, parts, rows, batch, chunk, coverage):
    df = spark.range(rows).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).repartition(parts)
    got = tables.draw_minibatches(df, "k", batch, chunk, coverage, seed=1, passes=2).toPandas()
    want = 0
    for c in range(math.ceil(rows / chunk)):
        size = min(chunk, rows - c * chunk)
        want += 2 * batch * coverage * (size // batch)
    assert len(got) == want
    if want:
        assert (got.v == 2 * got.k).all() and (got.chunk == got.k // chunk).all()
        groups = got.groupby(["pass", "chunk", "draw"])
        assert (groups.size() == batch).all() and (groups.k.nunique() == batch).all()
        assert groups.slot.apply(lambda s: sorted(s) == list(range(1, batch + 1))).all()
    with pytest.raises(ValueError):
        tables.draw_minibatches(df, "k", 3, 10)


def test_minibatches_are_never_broadcast(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"))
    total = tables.draw_minibatches(df, "k", 500, 5_000, 2, seed=1).agg(F.count("k"), F.max("slot"))
    assert total.collect()[0][0] == 40_000
    plan = total._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]  # as it was run
    assert "isFinalPlan=true" in plan and "SortMergeJoin [chunk" in plan and "BroadcastHashJoin [chunk" not in plan


def test_samples_of_any_size_agree(spark, monkeypatch):
    df = spark.range(3_000).select(F.col("id").alias("k")).repartition(9)
    small = {r["k"] for r in tables.sample_rows(df, 700, "k", 4).collect()}
    monkeypatch.setattr(tables, "TOP_K_LIMIT", 10)
    assert {r["k"] for r in tables.sample_rows(df, 700, "k", 4).collect()} == small and len(small) == 700


def test_perturbation_uses_the_batch_deviation(spark):
    pdf = pd.DataFrame({"k": range(200), "b": [i % 2 for i in range(200)], "x": np.arange(200) * 1.0 + 1e6, "y": 5.0})
    for batch in (None, "b"):
        out = tables.perturb_rows(spark.createDataFrame(pdf), ["x", "y"], "k", batch).orderBy("k").toPandas()
        for _, part in (pdf.groupby("b") if batch else [(0, pdf)]):
            gap = (out.loc[part.index, ["x", "y"]] - part[["x", "y"]]).to_numpy() / part[["x", "y"]].to_numpy().std() / 0.5
            assert gap.min() > 0 and gap.max() < 1 and abs(gap.mean() - 0.5) < 0.06


def test_shuffled_csv(spark, tmp_path):
    df = spark.range(500).select(F.col("id").alias("k"), F.lit("a,b").alias("t"))
    tables.write_shuffled(df, str(tmp_path / "o"), "k", 1)
    files = sorted((tmp_path / "o").glob("part-*.csv"))
    keys = [k for f in files for k in pd.read_csv(f).k]
    assert sorted(keys) == list(range(500)) and keys != sorted(keys)
    assert keys == [r["k"] for r in tables.shuffle_rows(df.repartition(3), "k", 1).collect()]


def test_log_checkpoints_and_choice(spark, tmp_path):
    lines = [f"2019 Iter: {i * 100}; D loss: {1 + 1 / i:.4f}; G loss: {0.5 + i / 200:.4f}; similarity: {abs(i - 44) / 100:.4f}" for i in range(1, 101)]
    (tmp_path / "log").write_text("\n".join([*lines, "Iter: 4001000; D loss: 1e-3; G loss: -2.5; penalty: 0.1", "started"]) + "\n")
    log = training_log.read_training_log(spark, str(tmp_path / "log"))
    rows = {r["iter"]: r for r in log.collect()}
    assert rows[200]["D_loss"] == 1.5 and rows[200]["similarity"] == 0.42
    assert rows[4001000]["G_loss"] == -2.5 and rows[4001000]["similarity"] is None and rows[None]["G_loss"] is None
    folder = tmp_path / "models"
    folder.mkdir()
    for i in [*range(1_000, 10_001, 1_000), 4001000]:
        (folder / f"check_point_{i}.ckpt.meta").write_text("x")
    (folder / "check_point_4400.ckpt.index").write_text("x")
    saved = training_log.list_checkpoints(spark, str(folder))
    assert saved.count() == 11
    assert training_log.best_checkpoint(log, saved).first()["iter"] == 4_000
    assert training_log.loss_trace(log.where("similarity is not null").select("iter", "G_loss"), 1_000).count() == 10


def test_whole_round_trip_through_files(spark, tmp_path):
    train = view(spark, SF, TRAIN)
    done = preprocess(train, HEADER)
    assert [c for c, r in done.roles.roles.items() if r == ""] == ["o_orderkey"]
    assert set(done.roles.conditions) >= {"bal_missing", "spike_highfreq", "target", "flag01", "segment_null"}
    assert done.table.where(" or ".join(f"{c} is null" for c in done.table.columns)).count() == 0
    write_preprocessed(spark, done, str(tmp_path), "o_orderkey")
    header = rl.read_role_header(spark, str(tmp_path / "scaled_header"))
    assert header.roles == done.roles.roles
    scaled = rl.read_typed_table(spark, str(tmp_path / "scaled"), header).withColumn("o_orderkey", F.col("o_orderkey").cast("long"))
    back = postprocess(scaled, HEADER, read_stats(spark, str(tmp_path)), "o_orderkey", restore_indicators=True)
    a = train.orderBy("o_orderkey").toPandas()
    b = back.orderBy("o_orderkey").toPandas()
    assert list(b.columns) == HEADER.names
    for c in ("price", "few", "const", "spike"):
        assert np.allclose(a[c], b[c], rtol=1e-6, atol=1e-4), c
    assert (a.bal.isna() == b.bal.isna()).all() and np.allclose(a.bal.dropna(), b.bal.dropna(), atol=1e-4)
    assert (a.segment.fillna("") == b.segment).all() and (a.status == b.status).all() and (a.flag01 == b.flag01).all()
    assert (a.target == b.target).all()
    # the driver's keys count from 0, so numbering them and sorting by them agree
    original = rl.Roles({"unq1": "K", "price": "N"} | {"target": "L"})
    args = (scaled, original, read_stats(spark, str(tmp_path)), "o_orderkey")
    assert sorted(postprocess(*args).collect()) == sorted(postprocess(*args, numbered=True).collect())
    # edited lambdas are applied as they are
    stats = done.stats["boxcox"]
    stats.columns["price"]["lambd"] = 0.0
    again = preprocess(train, HEADER, boxcox=stats)
    assert again.stats["boxcox"].columns["price"]["lambd"] == 0.0


def test_generation_job_picks_the_best_network(spark):
    log = spark.createDataFrame([(f"Iter: {i}; D loss: 1; G loss: 1; similarity: {s}",) for i, s in ((5, 0.3), (6, 0.1), (7, 0.0))], "value string")
    files = spark.createDataFrame([("m/check_point_5.ckpt.meta",), ("m/check_point_6.ckpt.meta",)], "path string")
    assert choose_iteration(log, files) == 6
    df = spark.range(50).select(F.col("id").alias("k"), F.lit(0.0).alias("a"), F.lit(0.0).alias("b"), F.lit(0.5).alias("g"), F.lit(-0.5).alias("h"))
    header = rl.Roles({"k": "", "a": "N", "b": "N", "g": "G", "h": "G"})
    seen = []
    out = generate(df, header, lambda i: seen.append(i) or tiny_net(1, 4, 2), 2, ["k"], log_lines=log, files=files)
    assert seen == [6] and out.count() == 50 and out.columns == ["id", "a", "b", "g", "h"]
    assert generate(df, header, lambda i: tiny_net(1, 4, 2), 2, ["k"], rows=7, using_iter=5).count() == 7
