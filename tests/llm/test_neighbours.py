import numpy as np
from pyspark.sql import functions as F

from tabloom.llm.neighbours import nearest


def brute(rows, asks, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v) and len(v) == 4]
    out = []
    for q, x in {i: v for i, v in ok if asks(i)}.items():
        near = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in ok if i != q)[:k]
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


def test_odd_rows_and_ties(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.integers(-2, 3, 4).astype(float).tolist()) for i in range(60)] + [(200 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(30)]
    rows += [(300, None), (301, [0.0] * 4), (302, [None, 1.0, 1.0, 1.0]), (303, [float("nan")] * 4), (304, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (305, [1.0])]
    rows += [(20, [9.0, 9.0, 9.0, 9.0]), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, id int, vector string").repartition(4)
    rows = [x for x in rows if x[0] != 20]  # two vectors of one asking id: each asks
    got = nearest(df.where("vec_id is null or vec_id <> 20"), F.col("vec_id") % 10 == 0, 10).collect()
    want = brute(rows, lambda i: i % 10 == 0, 10)
    assert [(a, b, c) for a, b, c, _ in sorted(map(tuple, got))] == [(a, b, c) for a, b, c, _ in want]
    assert np.allclose([x[3] for x in sorted(map(tuple, got))], [x[3] for x in want], atol=0, rtol=1e-12)
    assert nearest(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert nearest(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).count() == 2
    assert nearest(df, F.col("vec_id") == -1).count() == 0


def test_recall_with_real_shards(spark):
    r = np.random.default_rng(2)
    x = r.standard_normal((5000, 32))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {}
    for row in nearest(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(row.query_id, []).append(row.vec_id)
    hits = []
    for q, found in got.items():
        away = ((x - x[q]) ** 2).sum(axis=1)
        hits.append(len(set(found) & set(np.argsort(away)[1:11].tolist())) / 10)
    assert len(hits) == 50 and np.mean(hits) >= 0.9


def test_a_longer_vector_leaves_the_others(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.standard_normal(4).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows + [(90, [1.0] * 6), (91, [2.0] * 6)], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, nearest(df, F.col("vec_id") % 10 == 0, 5).collect()))
    assert [x[:3] for x in got] == [x[:3] for x in brute(rows, lambda i: i % 10 == 0, 5)]
    tie = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, [1.0, 1.0]), (4, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert [x[:3] for x in map(tuple, nearest(tie, F.col("vec_id") == 3).collect())] == [(3, 1, 4)]
