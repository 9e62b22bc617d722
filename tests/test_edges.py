"""Empty inputs and less common options across operators."""

import datetime as dt

from pyspark.sql import functions as F

from chunkwise.functions import upper_strings
from chunkwise.operators import chunks, ledger, validate


def test_alias_mapping_and_upper_subset(spark):
    df = spark.createDataFrame([("a", "b", 1)], "legacy_name string, other string, n int")
    out = validate.alias_columns(df, ["name", "n"], aliases={"name": ["legacy_name"]})
    r = out.first()
    assert (r.name, r.n, r._present_name) == ("a", 1, True)
    up = upper_strings(df, ["other"]).first()
    assert (up.legacy_name, up.other, up.n) == ("a", "B", 1)


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "k long, s string, ts timestamp_ntz")
    s = chunks.dispatch_summary(empty, 500).first()
    assert (s.total_items, s.chunks) == (0, 0)
    m = chunks.map_reduce_sum(empty, "k").first()
    assert (m.total, m.n_tasks) == (0, 0)
    h = ledger.health_stats(empty, "s", empty, "ts", empty, "s",
                            as_of=F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")).first()
    assert tuple(h) == (0, 0, 0)
    assert chunks.assign_chunks(empty, ["k"], 10).count() == 0
    assert chunks.concat_ordered(empty.selectExpr("k as chunk_id", "k as item_index")).count() == 0
    req = spark.createDataFrame([("t1",)], "task_id string")
    led = ledger.fold_task_ledger(spark.createDataFrame(
        [], "task_id string, task_name string, status string, updated_at timestamp_ntz, "
            "args string, kwargs string, result string, error string, event_seq long"))
    r = ledger.task_status_lookup(req, led).first()
    assert (r.state, r.ready, r.current, r.total) == ("PENDING", False, 0, 1)
    assert ledger.unique_key_violations(empty, ["k"]).count() == 0


def test_decode_body_edges(spark):
    from pyspark.sql import types as T
    from chunkwise.streaming import decode_body
    df = spark.createDataFrame([("5",), ("[1]",), ('{"k": "x"}',), ('{"k": 3}',), ('{"j": 1}',),
                                (None,), ("{bad",)], "body string")
    out = [(r.decoded, r.payload.k if r.payload else None) for r in decode_body(
        df, "body", T.StructType([T.StructField("k", T.IntegerType())])).collect()]
    assert out == [(False, None), (False, None), (False, None), (True, 3), (True, None),
                   (False, None), (False, None)]
