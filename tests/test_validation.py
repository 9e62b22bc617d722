"""Record validation and shaping on small golden fixtures (invented records)."""

import json

import pytest
from pyspark.sql import functions as F

from chunkwise.operators import validate
from chunkwise.schemas import DATA_ENVELOPE, DATA_ENVELOPE_KEYS, PERSONS_ENVELOPE_KEYS
from chunkwise.sources import read_json_objects
from chunkwise.session import scratch_path
from chunkwise.functions import iso_timestamp, json_scalar, norm_category, round2

from conftest import PERSONS


def _raw(spark, records):
    """Persons as JSON text -> raw string columns, like a JSON source."""
    rows = [(json.dumps({"persons": records}),)]
    body = spark.createDataFrame(rows, "body string")
    return validate.explode_envelope(body, "body", PERSONS_ENVELOPE_KEYS, "persons")


def _check(spark, records):
    return validate.validate_persons(_raw(spark, records), map_col="item")


def test_valid_set(spark):
    out = _check(spark, PERSONS).orderBy("item_index").collect()
    assert [r.errors for r in out] == [[]] * 5
    assert out[0].person_id == "person000"          # camelCase alias accepted
    assert out[0].survived == 0                    # default applied to an absent field
    assert out[3].fare == 42.5 and out[2].pclass == 3


def test_edge_rows(spark):
    base = dict(PERSONS[0])
    cases = [
        {**base, "sex": "  FeMale\t"},             # padded / mixed case -> ok
        {**base, "embarked": "x"},                 # unknown category
        {**base, "age": None},                     # explicit null required field
        {**base, "pclass": 2.5},                   # fractional int
        {**base, "pclass": "3"},                   # numeric string -> ok
        {**base, "survived": None},                # explicit null on a defaulted int
        {k: v for k, v in base.items() if k != "fare"},  # missing required
        {**base, "person_id": "snake", "personId": None},  # snake_case spelling
    ]
    out = _check(spark, cases).orderBy("item_index").collect()
    assert out[0].errors == [] and out[0].sex == "female"
    assert out[1].errors == ["embarked: must be one of s,c,q"]
    assert "age: required" in out[2].errors
    assert out[3].errors == ["pclass: invalid value"] and out[3].pclass is None
    assert out[4].errors == [] and out[4].pclass == 3
    assert "survived: required" in out[5].errors
    assert "fare: required" in out[6].errors
    assert out[7].person_id == "snake" and out[7].errors == []


def test_typed_json_rounds_numbers_only(spark):
    from chunkwise.schemas import PERSONS_ENVELOPE_TYPED
    base = dict(PERSONS[0])
    cases = [
        {**base, "age": 22.555, "fare": "7.255"},   # number rounded, quoted kept
        {**base, "personId": 123},                  # non-string id rejected
        {**base, "pclass": "3", "sibsp": 2.0},      # lax ints
        {**base, "survived": None},                 # explicit null still invalid
        {k: v for k, v in base.items()},            # absent survived -> default 0
    ]
    body = spark.createDataFrame([(json.dumps({"persons": cases}),)], "body string")
    items = validate.explode_envelope(body, "body", PERSONS_ENVELOPE_TYPED, "persons")
    out = validate.validate_persons(items, map_col="item").orderBy("item_index").collect()
    assert out[0].errors == [] and out[0].age == round(22.555, 2) and out[0].fare == 7.255
    assert out[1].errors == ["person_id: must be a string"]
    assert out[2].errors == [] and (out[2].pclass, out[2].sibsp) == (3, 2)
    assert "survived: required" in out[3].errors
    assert out[4].errors == [] and out[4].survived == 0


def test_quarantine_keeps_every_row(spark):
    recs = [dict(p) for p in PERSONS] + [{**PERSONS[0], "sex": "unknown"}]
    checked = _check(spark, recs)
    valid, rejected = validate.split_valid(checked)
    assert valid.count() + rejected.count() == len(recs)
    assert rejected.count() == 1


def test_fail_chunk_rejects_whole_chunk(spark):
    recs = [dict(p) for p in PERSONS] + [{**PERSONS[0], "sex": "unknown"}]
    checked = _check(spark, recs) \
                      .withColumn("chunk_id", (F.col("item_index") / 3).cast("long"))
    valid, rejected = validate.split_valid(checked, mode="fail_chunk")
    assert sorted(r.item_index for r in valid.collect()) == [0, 1, 2]
    assert rejected.count() == 3


def test_fail_job_raises(spark):
    recs = [{**PERSONS[0], "sex": "unknown"}]
    checked, _ = validate.split_valid(_check(spark, recs), "fail_job")
    with pytest.raises(Exception, match="validation failed"):
        checked.collect()


def test_empty_input(spark):
    body = spark.createDataFrame([('{"data": []}',)], "body string")
    raw = validate.explode_envelope(body, "body", DATA_ENVELOPE_KEYS, "data")
    checked = validate.validate_persons(raw, map_col="item")
    valid, rejected = validate.split_valid(checked)
    assert valid.count() == 0 and rejected.count() == 0


def test_single_endpoint_takes_first(spark):
    body = spark.createDataFrame([(json.dumps({"data": PERSONS[:2]}),)], "body string")
    one = validate.explode_envelope(body, "body", DATA_ENVELOPE, "data", first_only=True)
    rows = one.select("item.personId").collect()
    assert [r.personId for r in rows] == ["person000"]


def test_scalars(spark):
    df = spark.createDataFrame([(2.675, " Male ", "x")], "v double, s string, t string")
    r = df.select(round2("v").alias("r"), norm_category("s").alias("n"),
                  json_scalar("t").alias("j"), json_scalar(F.lit(None).cast("string"))
                  .alias("jn"),
                  iso_timestamp(F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")).alias("i"),
                  iso_timestamp(F.lit("2024-01-01 10:00:00.5").cast("timestamp_ntz"))
                  .alias("i2")).first()
    assert r.n == "male" and r.j == '"x"' and r.jn == "null"
    assert r.i == "2024-01-01T10:00:00" and r.i2 == "2024-01-01T10:00:00.500000"
    assert r.r == 2.67   # Python's round on the binary value (Spark's round gives 2.68)


def test_round_python_matches_python(spark):
    import random
    rnd = random.Random(11)
    xs = [2.675, 2.665, 1.005, 0.125, 0.375, -2.675, 22.555, 0.005, 1e-9, 12345678.125]
    xs += [round(rnd.uniform(-1000, 1000), 3) for _ in range(5000)]
    xs += [k / 8 for k in range(-800, 800)]
    xs += [123456789012345.67, 70368744177663.985, 70368744177664.01, 45035996273704.955]
    xs += [rnd.uniform(-1, 1) * 10 ** rnd.uniform(6, 15) for _ in range(5000)]
    xs += [(2 * rnd.randrange(2 ** 45) + 1) / 2 ** k for k in range(1, 9) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in xs], "x double")
    for d in (1, 2):
        got = [r[0] for r in df.select(round2("x", d).alias("r")).collect()]
        assert [g for g, x in zip(got, xs) if g != round(x, d)] == []
    half_up = df.select(round2("x", 2, mode="half_up")).collect()
    assert half_up[0][0] == 2.68


def test_prediction_struct_threshold(spark):
    from chunkwise.functions import threshold_label
    df = spark.createDataFrame([("a", 0.5), ("b", 0.504)], "person_id string, probability double")
    df = df.withColumn("survived", threshold_label("probability"))
    out = {r.data.person_id: r.data for r in validate.prediction_struct(df).collect()}
    assert out["a"].survived == 0 and out["b"].survived == 1
    assert out["b"].probability == 0.5        # rounded for output after thresholding


def test_json_array_file(spark):
    path = scratch_path(spark, "persons-array")
    import os
    from chunkwise.session import local_path
    os.makedirs(local_path(path), exist_ok=True)
    with open(os.path.join(local_path(path), "a.json"), "w") as fh:
        json.dump(PERSONS, fh)
    df = read_json_objects(spark, path, array_file=True)
    assert df.count() == 5
    checked = validate.validate_persons(df, map_col="record", keep=["item_index"])
    assert checked.filter(F.size("errors") == 0).count() == 5


def test_malformed_envelope_is_rejected_not_dropped(spark):
    bodies = spark.createDataFrame([("not json",), ('{"data": []}',),
                                    (json.dumps({"data": PERSONS[:1]}),)], "body string")
    items = validate.explode_envelope(bodies, "body", DATA_ENVELOPE_KEYS, "data", keep=["body"])
    checked = validate.validate_persons(items, map_col="item", keep=["body"])
    valid, rejected = validate.split_valid(checked)
    assert valid.count() == 1
    assert [r.body for r in rejected.collect()] == ["not json"]


def test_write_split_one_pass(spark):
    recs = [dict(p) for p in PERSONS] + [{**PERSONS[0], "sex": "unknown"}]
    paths = validate.write_split(_check(spark, recs), scratch_path(spark, "split"))
    assert spark.read.parquet(paths["valid"]).count() == 5
    bad = spark.read.parquet(paths["rejected"]).collect()
    assert len(bad) == 1 and bad[0].errors == ["sex: must be one of male,female"]


def test_all_null_records_are_rejected(spark):
    nulls = [{k: None for k in PERSONS[0]} for _ in range(3)]
    checked = _check(spark, nulls)
    valid, rejected = validate.split_valid(checked)
    assert valid.count() == 0 and rejected.count() == 3
    errs = set(rejected.first().errors)
    assert {"sex: required", "age: required", "fare: required", "embarked: required"} <= errs


def test_json_lines_keep_malformed_records(spark):
    import os
    from chunkwise.session import local_path
    from chunkwise.sources import read_json_records
    from pyspark.sql import types as T
    path = scratch_path(spark, "jsonl")
    os.makedirs(local_path(path), exist_ok=True)
    with open(os.path.join(local_path(path), "part.json"), "w") as fh:
        fh.write('{"a": 1, "b": "x"}\n{"a": 2, \n{"a": 3, "b": "z"}\n')
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    with pytest.raises(Exception, match="[Mm]alformed"):
        read_json_records(spark, path, schema).collect()
    df = read_json_records(spark, path, schema, corrupt_col="_bad").cache()
    assert df.count() == 3
    assert df.filter(F.col("_bad").isNotNull()).count() == 1
    assert sorted(r.a for r in df.filter(F.col("_bad").isNull()).collect()) == [1, 3]
    typed = read_json_objects(spark, path, typed=True)
    assert typed.filter(F.col("record").isNull()).count() == 1


def test_processor_roundtrip_and_transform(spark):
    from chunkwise.config import FeatureSpec
    from chunkwise.operators.features import Processor
    df = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (2.0, None)], "x double, c string")
    spec = FeatureSpec(num_vars=("x",), cat_vars=("c",), target="y", id_col="id")
    proc = Processor.fit(df, spec, with_categories=True)
    again = Processor.from_json(proc.to_json())
    assert again == proc and proc.feature_names() == ["num_vars__x", "cat_vars__c_a",
                                                       "cat_vars__c_b"]
    rows = again.transform(df.union(spark.createDataFrame([(9.0, "new")], df.schema))).collect()
    assert [tuple(r) for r in rows] == [(0.0, 1.0, 0.0), (1.0, 0.0, 1.0), (0.5, 0.0, 0.0),
                                        (4.0, 0.0, 0.0)]


def test_fail_job_survives_column_pruning(spark):
    recs = [dict(p) for p in PERSONS] + [{**PERSONS[0], "sex": "unknown"}]
    checked, _ = validate.split_valid(_check(spark, recs), "fail_job")
    with pytest.raises(Exception, match="validation failed"):
        checked.select("person_id").collect()
    ok, _ = validate.split_valid(_check(spark, PERSONS), "fail_job")
    assert ok.select("person_id").count() == 5


def test_fail_chunk_needs_chunk_ids(spark):
    with pytest.raises(ValueError, match="assign_chunks"):
        validate.split_valid(_check(spark, PERSONS), "fail_chunk")


def test_lax_numbers(spark):
    from chunkwise.functions import lax_double, lax_int
    cases = {"2": 2, "2.0": 2, " 7 ": 7, "-2147483648": -2147483648, "9223372036854775807": 2 ** 63 - 1,
             "9223372036854775808": None, "2.5": None, "12d": None, "12f": None, "1e3": None, "": None,
             "abc": None, "0x10": None, "1 2": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    assert [r.v for r in df.select(lax_int("s").alias("v")).collect()] == list(cases.values())
    doubles = {"1.5": 1.5, "1e3": 1000.0, "-.5": -0.5, "12d": None, "5f": None, "": None, "x": None}
    df = spark.createDataFrame([(k,) for k in doubles], "s string")
    assert [r.v for r in df.select(lax_double("s").alias("v")).collect()] == list(doubles.values())
    df = spark.createDataFrame([(3.0, 2 ** 62 + 1), (1e10, 5), (2.5, None)], "d double, n bigint")
    assert [tuple(r) for r in df.select(lax_int("d"), lax_int("n")).collect()] == \
        [(3, 2 ** 62 + 1), (10 ** 10, 5), (None, None)]
    assert lax_int("s") is not None and df.select(lax_int("d").alias("v")).dtypes == [("v", "bigint")]
