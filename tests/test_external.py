"""Scoring with a model that is not Spark's."""

import pickle

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkwise.operators import external
from chunkwise.operators.external import external_model, loaded, score_external
from chunkwise.plans.learned import Line


def _logistic(weights):
    """A classifier as a script defines it: its class is pickled with it."""
    class Logistic:
        def predict_proba(self, matrix):
            p = 1 / (1 + np.exp(-matrix @ np.asarray(weights, float)))
            return np.column_stack([1 - p, p])
    return Logistic()


def _rows(spark, n=500):
    return spark.range(n, numPartitions=4).select(
        "id", (F.col("id") % 7 - 3).alias("a"), F.when(F.col("id") % 11 != 0, F.col("id") / 100.0).alias("b"),
        F.concat(F.lit("x"), F.col("id").cast("string")).alias("name"), F.lit(5).alias("survived"))


def test_scores_equal_the_models_own(spark):
    from pyspark import cloudpickle
    own, df = _logistic([0.4, -0.2]), _rows(spark)
    out = score_external(external_model(spark, cloudpickle.dumps(own), ["a", "b"]), df).collect()
    known = [r for r in out if r["b"] is not None]
    want = own.predict_proba(np.array([[r["a"], r["b"]] for r in known], float))[:, 1]
    assert np.allclose([r["probability"] for r in known], want, rtol=1e-15)
    assert [r["survived"] for r in known] == [int(p > 0.5) for p in want]


def test_lines_and_nulls(spark):
    df = _rows(spark)
    out = score_external(external_model(spark, Line(0.3, 0.1), ["b"]), df)
    assert out.columns == ["id", "a", "b", "name", "probability", "survived"]
    got = out.collect()
    assert len(got) == 500
    for r in got:
        if r["id"] % 11 == 0:
            assert r["probability"] is None and r["survived"] is None
        else:
            want = min(max(0.1 + 0.3 * (r["id"] / 100.0), 0.0), 1.0)
            assert r["probability"] == want and r["survived"] == int(want > 0.5)
            assert r["name"] == f"x{r['id']}"


def test_missing_features_and_large_models_are_refused(spark, monkeypatch):
    with pytest.raises(Exception):
        score_external(external_model(spark, Line(1, 0), ["nope"]), _rows(spark))
    monkeypatch.setattr(external, "MOST_BYTES", 10)
    with pytest.raises(ValueError):
        external_model(spark, Line(1, 0), ["a"])


def test_loaded_once_in_a_process(spark):
    """Two batches, two models in turn: each is unpickled once; old ones make room."""
    model = external_model(spark, Line(1, 0), ["a"])
    assert loaded(model) is loaded(model)
    again = external_model(spark, pickle.dumps(Line(1, 0)), ["a"])
    assert loaded(again) is loaded(model)       # the same bytes
    for k in range(external.KEPT_MODELS):
        loaded(external_model(spark, Line(1, k + 1), ["a"]))
    assert len(external._models) == external.KEPT_MODELS


def test_batches_of_any_size(spark):
    df = _rows(spark)
    want = sorted(map(tuple, score_external(external_model(spark, Line(0.2, 0), ["b"]), df).collect()))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("1", "7"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = score_external(external_model(spark, Line(0.2, 0), ["b"]), df).collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert score_external(external_model(spark, Line(0.2, 0), ["b"]), df.limit(0)).collect() == []


def test_no_shuffle(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 0.1)
    plan = score_external(external_model(spark, Line(1, 0), ["x"]), df)._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()
