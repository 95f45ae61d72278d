"""Boosted trees on histograms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import boosting


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(rng.integers(0, 40)), float(rng.normal()) if i % 9 else None, float(rng.integers(0, 3))) for i in range(3_000)]
    rows = [(*r, None if r[0] % 5 == 0 else 2.0 * (r[1] > 17) - (r[3] == 1) + 0.1 * float(rng.normal()), 1) for r in rows]
    return spark.createDataFrame(rows, "k long, `a.1` double, `b``2` double, c double, y double, bins int").cache()


FEATURES = ["a.1", "b`2", "c"]


def predicted(model, df):
    return np.array([r[0] for r in df.orderBy("k").select(model.predict(F.lit(True), -9999.0)).collect()])


def plain(bins, y, rounds, depth, least, penalty, step, base):
    """The same trees, row by row."""
    out = np.full(len(y), base)

    def leaf(own, left):
        g, n = (out[own] - y[own]).sum(), len(own)
        best = (0.0, None)
        for f in range(bins.shape[1]) if left else ():
            for at in range(bins[:, f].max() + 1):
                low = own[bins[own, f] <= at]
                if least <= len(low) <= n - least:
                    gl = (out[low] - y[low]).sum()
                    gain = gl**2 / (len(low) + penalty) + (g - gl) ** 2 / (n - len(low) + penalty) - g**2 / (n + penalty)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, at))
        if best[1] and best[0] > 1e-9 * max(g * g, 1) / n:
            f, at = best[1]
            inside = bins[own, f] <= at
            return leaf(own[inside], left - 1) + leaf(own[~inside], left - 1)
        return [(own, -step * g / (n + penalty))]

    for _ in range(rounds):
        for own, w in leaf(np.arange(len(y)), depth):
            out[own] += w
    return out


def test_equals_trees_grown_row_by_row(table):
    model = boosting.fit_boosted(table, "y", FEATURES, maxIter=4, maxDepth=3, stepSize=0.4)
    known = table.where("y IS NOT NULL").orderBy("k").select("y", *model.bins(-9999.0)).toPandas().to_numpy()
    want = plain(known[:, 1:].astype(int), known[:, 0], 4, 3, 30, 1.0, 0.4, 0.5)
    assert np.allclose(predicted(model, table.where("y IS NOT NULL")), want)
    assert np.std(predicted(model, table) - 2.0 * np.array([r[0] > 17 for r in table.orderBy("k").select("`a.1`").collect()])) < 0.6


def test_cells_in_a_table_give_the_same_model(table):
    settings = dict(maxIter=2, maxDepth=2, stepSize=0.5, base=None)
    one = boosting.fit_boosted(table, "y", FEATURES, **settings)
    two = boosting.fit_boosted(table, "y", FEATURES, local_cells=0, **settings)
    for a, b in zip(one.trees, two.trees):
        assert (a.feature == b.feature).all() and (a.at == b.at).all() and np.allclose(a.weight, b.weight)
    assert np.allclose(predicted(one, table), predicted(two, table)) and len(two.trees) == 2


def test_small_children_and_nothing_to_learn_from(table):
    model = boosting.fit_boosted(table, "y", FEATURES, maxIter=1, minInstancesPerNode=5_000)
    assert (model.trees[0].feature < 0).all()
    assert boosting.fit_boosted(table.limit(0), "y", FEATURES).trees == []
    none = boosting.fit_boosted(table, "y", [], base=None)
    assert table.select(none.predict(F.col("k") < 2, 0.0).alias("p")).where("p IS NOT NULL").count() == 2
