"""The README's job example, end to end: JSON lines -> validate -> score -> write."""

import json
import os

from chunkwise.config import FeatureSpec, ModelParams
from chunkwise.operators.model import load_model, save_model
from chunkwise.plans.jobs import batch_predict, train
from chunkwise.session import local_path, scratch_path
from chunkwise.sources import read_json_objects

from conftest import PERSONS


def test_readme_job_example(spark):
    people = [dict(PERSONS[i % 5], personId=f"p{i}", survived=i % 2) for i in range(30)]
    raw = spark.createDataFrame(people).withColumnRenamed("personId", "person_id")
    res = train(raw, FeatureSpec(), ModelParams(n_estimators=3, max_depth=2, n_splits=2))
    model_path = save_model(res.model, scratch_path(spark, "example-model"))
    src, out = scratch_path(spark, "example-in"), scratch_path(spark, "example-out")
    os.makedirs(local_path(src))
    with open(os.path.join(local_path(src), "a.json"), "w") as fh:
        for p in PERSONS + [{**PERSONS[0], "embarked": "zz"}]:
            fh.write(json.dumps(p) + "\n")

    records = read_json_objects(spark, src, typed=True)
    persons, predictions, rejected = batch_predict(load_model(model_path), records,
                                                   map_col="record")
    predictions.write.mode("append").parquet(f"{out}/predictions")
    persons.write.mode("append").parquet(f"{out}/persons")
    rejected.write.mode("append").parquet(f"{out}/rejected")

    assert spark.read.parquet(f"{out}/predictions").count() == 5
    assert spark.read.parquet(f"{out}/persons").count() == 5
    bad = spark.read.parquet(f"{out}/rejected").collect()
    assert len(bad) == 1 and bad[0].errors == ["embarked: must be one of s,c,q"]
