"""Registered queries ask for the whole of what their operators do."""

from suite import queries
from tabloom.operators import impute


def test_impute_queries_train_all_rounds(spark, monkeypatch):
    df = spark.createDataFrame([(1, 1.0, 2.0, None, 0.0)], "o_orderkey long, price double, bal double, rare_null double, target double")
    asked = []
    monkeypatch.setattr(queries, "train", lambda spark, d: df)
    monkeypatch.setattr(impute, "impute_model", lambda df, cols, features, **boosting: asked.append({**impute.BOOSTING, **boosting}) or df)
    queries.impute_model(spark, "")
    queries.impute_model_facts(spark, "")
    assert [x["maxIter"] for x in asked] == [200, 200]
