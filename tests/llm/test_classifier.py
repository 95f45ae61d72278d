import random

import pyarrow as pa
import pytest

from tabloom.llm import classifier as cl


def rows(n, seed=1):
    r = random.Random(seed)
    good = lambda: " ".join(r.choice("the of and into with green house river".split()) for _ in range(r.randint(5, 60)))
    bad = lambda: r.choice([lambda: "BUY!! " * r.randint(3, 30), lambda: "a | b | " * r.randint(3, 20), lambda: "spam spam " * r.randint(3, 20)])()
    return [(i, good() if i % 2 else bad(), i % 2) for i in range(n)]


def test_held_out_labels(spark, frame):
    data = rows(160)
    labelled = spark.createDataFrame([(i, t, y) for i, t, y in data if i % 5], "doc_id long, text string, label int")
    model = cl.fit(frame([(i, t) for i, t, _ in data]), labelled.drop("text"))
    held = [(i, t) for i, t, _ in data if i % 5 == 0]
    odd = [(1000, None), (1001, ""), (1002, "the of " * 30_000), (1003, " ")]
    got = {r.doc_id: r.score for r in cl.score(frame(held + odd), model, ["doc_id", "n", "__keep"]).collect()}
    assert all((got[i] > 0.5) == bool(i % 2) for i, _ in held)
    assert got[1000] == got[1001] == 0 and got[1002] > 0.5 and 0 <= got[1003] <= 1
    assert cl.score(frame(held).limit(0), model, ["doc_id"]).count() == 0


@pytest.mark.parametrize("labels,score", [([], 0.5), ([1, 1], 1.0), ([0], 0.0), ([None], 0.5)])
def test_too_few_labels(spark, labels, score):
    df = spark.createDataFrame([(i, "some text", y) for i, y in enumerate(labels)], "doc_id long, text string, label int")
    model = cl.fit(df, df)
    assert model.scores(pa.array(["some text", None])).tolist() == [score, 0.0]


def test_fit_does_not_depend_on_the_partitions(spark):
    df = spark.createDataFrame(rows(60), "doc_id long, text string, label int")
    more = df.unionByName(df)  # repeated rows count once
    a, b = cl.fit(df.repartition(1), df), cl.fit(more.repartition(5), more)
    assert (a.weights == b.weights).all()
