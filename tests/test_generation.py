"""Networks, generation from them, and the losses."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from suite.fixtures import TINY_CONFIG, tiny_net
from tabloom.operators import generate as gn
from tabloom.operators import losses, moments
from tabloom.operators.network import Layer, Network, dense_forward, layer_order


def numpy_forward(net, x):
    for layer in net.layers:
        if layer.kind == "dense":
            x = x @ layer.weight + layer.bias
        elif layer.kind == "relu":
            x = np.maximum(x, 0)
        elif layer.kind == "sigmoid":
            x = 1 / (1 + np.exp(-x))
    return x


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(rng.normal(size=(500, 4)), columns=["n1", "n2", "g1", "g2"])
    pdf["g1"], pdf["g2"] = np.sign(pdf.g1) / 2, np.sign(pdf.g2) / 2
    pdf["k"] = rng.permutation(500)
    return pdf


@pytest.mark.parametrize("how", ["expression", "batches", "relational"])
def test_forward_forms_agree(spark, table, how):
    rng = np.random.default_rng(9)
    net = Network(
        [
            Layer("a", "dense", weight=rng.normal(size=(4, 3)), bias=rng.normal(size=3)),
            Layer("r", "relu"),
            Layer("d", "dropout", rate=0.5),
            Layer("b", "dense", weight=rng.normal(size=(3, 2)), bias=rng.normal(size=2)),
            Layer("s", "sigmoid"),
        ]
    )
    cols = ["n1", "n2", "g1", "g2"]
    out = dense_forward(spark.createDataFrame(table), net, cols, ["o1", "o2"], how=how, key="k").toPandas().sort_values("k")
    assert np.allclose(out[["o1", "o2"]], numpy_forward(net, table.sort_values("k")[cols].to_numpy()))


def test_layers_follow_previous_and_weights_survive_a_table(spark):
    config = {
        "input": {"type": "dense", "size": 2, "previous": ""},
        "output": {"type": "dense", "previous": "l2"},
        "l2": {"type": "relu", "previous": "l1"},
        "l1": {"type": "dense", "previous": "input", "size": 3},
        "other": {"type": "sigmoid", "previous": "l1"},
    }
    assert [layer.name for layer in layer_order(config)] == ["l1", "l2", "output"]
    net = tiny_net(1, 4, 2)
    again = Network.from_frame(TINY_CONFIG, net.weights_frame(spark))
    for a, b in zip(net.dense, again.dense):
        assert np.array_equal(a.weight, b.weight) and np.array_equal(a.bias, b.bias)


def test_active_dropout_is_keyed_and_keeps_the_mean(spark):
    net = Network([Layer("d", "dropout", rate=0.25), Layer("o", "dense", weight=np.eye(8), bias=np.zeros(8))])
    df = spark.range(4_000).select("id", *[F.lit(1.0).alias(f"x{i}") for i in range(8)])
    ins, outs = [f"x{i}" for i in range(8)], [f"y{i}" for i in range(8)]
    run = lambda d: dense_forward(d, net, ins, outs, mc_dropout=True, key="id", seed=3).orderBy("id").toPandas()[outs].to_numpy()
    got = run(df)
    assert set(np.unique(got)) == {0.0, 1 / 0.75}
    assert abs(got.mean() - 1) < 0.02 and abs((got == 0).mean(axis=0) - 0.25).max() < 0.03
    assert np.array_equal(got, run(df.repartition(7)))


def test_float32_stays_close(spark, table):
    net = tiny_net(1, 4, 2)
    cols = ["n1", "n2", "g1", "g2"]
    df = spark.createDataFrame(table)
    a, b = (dense_forward(df, net, cols, ["o1", "o2"], how="batches", dtype=t).orderBy("k").toPandas()[["o1", "o2"]] for t in ("float32", "float64"))
    assert np.allclose(a, b, atol=1e-5) and not np.array_equal(a, b)


@pytest.mark.parametrize("parts", [1, 4, 17])
@pytest.mark.parametrize("rows", [3, 500, 1_207])
def test_conditions_repeat_in_order(spark, table, parts, rows):
    df = spark.createDataFrame(table).repartition(parts)
    got = gn.generate_conditional(df, tiny_net(1, 4, 2), ["n1", "n2"], ["g1", "g2"], ["k"], rows, 2, seed=1).orderBy("id").toPandas()
    assert got.id.tolist() == list(range(rows))
    y = table.sort_values("k")[["g1", "g2"]].to_numpy()[np.arange(rows) % 500]
    assert np.array_equal(got[["g1", "g2"]], y)
    z = gn.sample_noise(spark.range(rows), 2, "id", 1).orderBy("id").toPandas()[["z0", "z1"]].to_numpy()
    assert np.allclose(got[["n1", "n2"]], numpy_forward(tiny_net(1, 4, 2), np.hstack([z, y])))


def test_pinned_and_uniform_conditions(spark, table):
    df = spark.createDataFrame(table)
    args = (df, tiny_net(1, 4, 2), ["n1", "n2"], ["g1", "g2"])
    assert set(gn.generate_pinned(*args, ["k"], 100, 2, "g1").toPandas().g1) == {0.5}
    got = gn.generate_uniform(*args, 4_000, 2).toPandas().groupby(["g1", "g2"]).size()
    assert len(got) == 4 and got.min() > 850


def test_translation_stops_after_whole_batches(spark):
    df = spark.range(12_000).select(F.col("id").alias("k"), (F.col("id") / 1e4).alias("a"), F.lit(1.0).alias("b"))
    net = tiny_net(5, 2, 2)
    assert gn.translate_a_to_b(df, net, ["a", "b"], ["b", "c"], "k", 5_001).count() == 10_000
    assert gn.translate_a_to_b(df, net, ["a", "b"], ["b", "c"], "k", 50_000).count() == 12_000
    named = df.withColumn("k", F.lpad(F.col("k").cast("string"), 6, "0"))
    assert gn.translate_a_to_b(named, net, ["a", "b"], ["b", "c"], "k", 5_000).agg(F.max("k")).first()[0] == "004999"


def test_fitted_generator_has_the_moments_of_the_data(spark):
    rng = np.random.default_rng(10)
    y = np.sign(rng.normal(size=(3_000, 2))) / 2
    x = y @ rng.normal(size=(2, 3)) + rng.normal(size=(3_000, 3)) @ rng.normal(size=(3, 3)) + 2
    pdf = pd.DataFrame(np.hstack([x, y]), columns=["a", "b", "c", "g", "h"]).assign(k=range(3_000))
    net = moments.fit_generator(spark.createDataFrame(pdf), ["a", "b", "c"], ["g", "h"])
    w, b = net.dense[0].weight, net.dense[0].bias
    one_y = np.hstack([np.ones((3_000, 1)), y])
    beta = np.linalg.lstsq(one_y, x, rcond=None)[0]
    assert np.allclose(b, beta[0]) and np.allclose(w[3:], beta[1:])
    assert np.allclose(w[:3].T @ w[:3], np.cov((x - one_y @ beta).T, ddof=0))
    made = gn.generate_conditional(spark.createDataFrame(pdf), net, ["a", "b", "c"], ["g", "h"], ["k"], 3_000, 3).toPandas()
    assert np.allclose(made[["a", "b", "c"]].mean(), x.mean(0), atol=0.15)
    wide = moments.cross_moments(spark.createDataFrame(pdf), [F.col(c) for c in ["a", "b", "c", "g", "h"] * 3])
    assert np.allclose(wide, np.tile(pdf[["a", "b", "c", "g", "h"]], 3).T @ np.tile(pdf[["a", "b", "c", "g", "h"]], 3))


def test_losses_on_extreme_scores(spark):
    scored = spark.createDataFrame([(1, 800.0), (1, -800.0), (0, 0.0), (0, 1.0)], "label int, score double")
    row = losses.bce_loss(scored).first()
    assert np.isclose(row["disc_loss"], 400 + (np.log(2) + np.log1p(np.e)) / 2)
    assert np.isclose(losses.bce_loss(scored, halved=True).first()["disc_loss"], row["disc_loss"] / 2)
    assert np.isclose(row["gen_loss"], (np.log(2) + np.log1p(np.exp(-1))) / 2)
    assert losses.critic_gap(scored).first()["disc_loss"] == 0.5
    assert losses.realness_auc(scored).first()["auc"] == 0.5


def test_reconstruction_error_per_row(spark, table):
    df = spark.createDataFrame(table).withColumn("tag", F.col("k") * 2)
    net = tiny_net(1, 4, 2)
    got = gn.reconstruction_error(df, net, ["n1", "n2"], ["g1", "g2"], "k", 2, seed=4, ids=["tag"]).orderBy("k").toPandas()
    t = table.sort_values("k")
    z = gn.sample_noise(spark.createDataFrame(t[["k"]]), 2, "k", 4).orderBy("k").toPandas()[["z0", "z1"]].to_numpy()
    made = numpy_forward(net, np.hstack([z, t[["g1", "g2"]].to_numpy()]))
    assert np.allclose(got.error, np.abs(t[["n1", "n2"]].to_numpy() - made).sum(axis=1))
    assert (got.tag == 2 * got.k).all()
