"""The prediction contract: a model loads; a single prediction succeeds and echoes the id;
a batch is dispatched with ``total_items == len(input)``."""

import json

import pytest
from pyspark.sql import functions as F

from chunkwise.config import FeatureSpec, ModelParams
from chunkwise.operators import chunks, validate
from chunkwise.operators.model import load_model, save_model
from chunkwise.plans.jobs import batch_predict, train
from chunkwise.schemas import DATA_ENVELOPE_KEYS
from chunkwise.session import scratch_path

from conftest import PERSONS


@pytest.fixture(scope="module")
def model_path(spark):
    people = []
    for i in range(30):
        p = dict(PERSONS[i % 5], personId=f"p{i}", survived=(i * 7) % 2)
        p["fare"] = p["fare"] + i
        people.append(p)
    raw = spark.createDataFrame(people).withColumnRenamed("personId", "person_id")
    res = train(raw, FeatureSpec(), ModelParams(n_estimators=3, max_depth=2, n_splits=2))
    return save_model(res.model, scratch_path(spark, "contract-model"))


def _items(spark, records):
    body = spark.createDataFrame([(json.dumps({"data": records}),)], "body string")
    return validate.explode_envelope(body, "body", DATA_ENVELOPE_KEYS, "data")


def test_model_loads(model_path):
    model = load_model(model_path, use_cache=False)
    names = [type(s).__name__ for s in model.stages]
    assert names == ["SQLTransformer", "StringIndexerModel", "OneHotEncoderModel", "VectorAssembler",
                     "RandomForestClassificationModel"]


def test_single_prediction(spark, model_path):
    one = [{**{k: v for k, v in PERSONS[3].items() if k != "personId"}, "person_id": "solo",
            "id": 99}]                                               # "id" is ignored
    _, preds, rejected = batch_predict(load_model(model_path), _items(spark, one),
                                       map_col="item")
    rows = preds.collect()
    assert rejected.count() == 0 and len(rows) == 1
    assert rows[0].status == "success" and rows[0].data.person_id == "solo"
    assert 0.0 <= rows[0].data.probability <= 1.0


def test_batch_dispatch(spark):
    items = _items(spark, PERSONS[:2])
    s = chunks.dispatch_summary(items, 500).first()
    assert s.status == "dispatched" and s.total_items == 2 and s.chunks == 1
    c = chunks.assign_chunks(items.select("item_index"), ["item_index"], 500)
    assert c.agg(F.countDistinct("chunk_id")).first()[0] == 1
