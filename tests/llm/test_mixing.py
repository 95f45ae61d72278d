import pytest
from pyspark.sql import functions as F

from tabloom.llm.mixing import mix



def rows(n=300):
    out = []
    for i in range(n):
        source, lang = ("hot" if i % 3 else f"s{i % 5}"), ("xx" if i % 7 else None)
        out.append((i, "word " * (1 + i % 11), lang, source))
    return out + [(None, None, "xx", None), (900, "", None, "hot"), (1, "word", "xx", "hot")]


def columns():
    return {"source": F.col("source"), "lang": F.col("lang")}


def test_expected_shares_meet_the_targets(spark, frame):
    goal = spark.createDataFrame([("hot", 0.3), ("s0", 0.3), ("s3", 0.4), ("unknown", 5.0)], "value string, share double")
    out = mix(frame(rows()), columns(), targets={"source": goal}, sweeps=60)
    p = out.groupBy("source").agg(F.sum(F.col("probability") * F.col("tokens")).alias("w")).collect()
    total = sum(r.w for r in p)
    share = {r[0]: r.w / total for r in p}
    assert share["hot"] == pytest.approx(0.3, abs=1e-6) and share["s3"] == pytest.approx(0.4, abs=1e-6) and share["(none)"] == 0
    most = out.agg(F.max("probability"), F.min("probability")).first()
    assert most[0] == pytest.approx(1.0) and most[1] >= 0


def test_same_draw_whatever_the_partitions(frame):
    given = frame(rows())
    one = sorted((r.doc.doc_id or -1, r.kept) for r in mix(given.repartition(1), columns()).collect())
    two = sorted((r.doc.doc_id or -1, r.kept) for r in mix(given.repartition(5), columns()).collect())
    assert one == two and any(k for _, k in one) and len(one) == len(rows())
    assert mix(given, columns()).select("doc.*").columns == given.columns


def test_empty_table(frame):
    assert mix(frame(rows()).limit(0), columns()).count() == 0


def test_a_stray_row_does_not_shrink_a_sized_sample(frame):
    stray = [(5000, "one two three four five", "zz", "stray")]
    for given in (rows(), rows() + stray):
        for size in (0.3, 0.7):
            out = mix(frame(given), columns(), size=size)
            kept, whole, most = out.agg(F.sum(F.col("probability") * F.col("tokens")), F.sum("tokens"), F.max("probability")).first()
            assert kept == pytest.approx(size * whole, rel=1e-9) and most <= 1
    assert mix(frame(given), columns(), size=1.0).where("tokens > 0 and probability < 0.999999").count() == 0
    assert mix(frame(given).limit(0), columns(), size=0.5).count() == 0
