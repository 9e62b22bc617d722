"""Task ledger fold/merge semantics and ledger table operations."""

import datetime as dt

from pyspark.sql import functions as F

from chunkwise.operators import ledger
from chunkwise.session import scratch_path
from chunkwise.sources import CardinalityError, read_if_exists, rewrite_table, row_id, scalar_one

import pytest

T0 = dt.datetime(2024, 1, 1)


def _events(spark, rows):
    return spark.createDataFrame(rows, "task_id string, task_name string, status string, "
                                       "updated_at timestamp_ntz, args string, kwargs string, "
                                       "result string, error string, event_seq long")


def test_retry_then_success_keeps_error(spark):
    ev = _events(spark, [
        ("t1", "job", "RETRY", T0, "a1", "k1", None, "boom", 1),
        ("t1", "job", "SUCCESS", T0 + dt.timedelta(seconds=5), "a2", "k2", "ok", None, 2),
    ])
    r = ledger.public_ledger(ledger.fold_task_ledger(ev)).first()
    assert (r.status, r.result, r.error, r.args) == ("SUCCESS", "ok", "boom", "a2")


def test_merge_equals_fold_any_split(spark):
    rows = [("t1", "n", s, T0 + dt.timedelta(seconds=i), str(i), None,
             "r" if s == "SUCCESS" else None, "e" if s in ("FAILURE", "RETRY") else None, i)
            for i, s in enumerate(["STARTED", "RETRY", "SUCCESS", "FAILURE", "SUCCESS"])]
    rows += [("t2", "n", "PENDING", T0, "x", None, None, None, 10)]
    full = ledger.public_ledger(ledger.fold_task_ledger(_events(spark, rows)))
    # late batch first: arrival order must not matter
    first = ledger.fold_task_ledger(_events(spark, rows[3:]))
    merged = ledger.public_ledger(ledger.merge_task_ledger(first, _events(spark, rows[:3])))
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, merged.collect()))


def test_status_lookup_unknown_is_pending(spark):
    led = ledger.fold_task_ledger(_events(spark, [
        ("t1", "n", "FAILURE", T0, None, None, None, "bad", 1)]))
    req = spark.createDataFrame([("t1",), ("nope",)], "task_id string")
    out = {r.task_id: r for r in ledger.task_status_lookup(req, led).collect()}
    assert out["nope"].state == "PENDING" and out["nope"].current == 0 and out["nope"].total == 1
    assert out["t1"].ready is True and out["t1"].error == "bad" and out["t1"].successful is False


def test_update_delete_null_semantics(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    up = ledger.update_where(df, F.col("s") == "a", {"s": F.lit("z")}).orderBy("id").collect()
    assert [r.s for r in up] == ["z", None]
    kept = ledger.delete_where(df, F.col("s") == "a").collect()
    assert [r.id for r in kept] == [2]            # null predicate keeps the row


def test_retention_strict_and_null_kept(spark):
    df = spark.createDataFrame([(1, T0), (2, T0 + dt.timedelta(days=1)), (3, None)],
                               "id int, created_at timestamp_ntz")
    cutoff = F.lit(T0 + dt.timedelta(days=1)).cast("timestamp_ntz")
    assert sorted(r.id for r in ledger.retained(df, "created_at", cutoff).collect()) == [2, 3]
    c = ledger.retention_counts({"t": (df, "created_at")}, cutoff).first()
    assert (c.deleted, c.kept) == (1, 2)


def test_scalar_one(spark):
    df = spark.range(3)
    assert scalar_one(df.filter("id = 1")).count() == 1
    with pytest.raises(CardinalityError):
        scalar_one(df)
    with pytest.raises(CardinalityError):
        scalar_one(df.filter("id = 9"))
    assert scalar_one(df.filter("id = 9"), allow_none=True).count() == 0


def test_rewrite_never_overwrites(spark):
    src, dst = scratch_path(spark, "src"), scratch_path(spark, "dst")
    spark.range(5).write.parquet(src)
    assert rewrite_table(spark, src, dst, lambda df: df.filter("id > 2")).count() == 2
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        rewrite_table(spark, src, dst, lambda df: df)
    assert spark.read.parquet(src).count() == 5 and spark.read.parquet(dst).count() == 2


def test_only_a_missing_path_reads_as_empty(spark, tmp_path):
    schema = spark.range(1).schema
    assert read_if_exists(spark, scratch_path(spark, "nothing"), schema).count() == 0
    bad = tmp_path / "bad.parquet"
    bad.write_bytes(b"not parquet")
    with pytest.raises(Exception):
        read_if_exists(spark, str(bad), schema).count()
    with pytest.raises(Exception):
        read_if_exists(spark, "nosuchscheme://host/x", schema)


def test_ledger_of_deltas(spark):
    from chunkwise.streaming import ledger_handler, read_ledger
    rows = [("t%d" % (i % 3), "n", s, T0 + dt.timedelta(seconds=i), str(i), None,
             "r%d" % i if s == "SUCCESS" else None, "e%d" % i if s == "RETRY" else None, i)
            for i, s in enumerate(["STARTED", "RETRY", "SUCCESS"] * 4)]
    full = sorted(map(tuple, ledger.public_ledger(
        ledger.fold_task_ledger(_events(spark, rows))).collect()))
    path, folded = scratch_path(spark, "ls"), scratch_path(spark, "ls-folded")
    handle = ledger_handler(path, lambda df: df)
    for b in range(4):                       # batches arrive newest first
        handle(_events(spark, rows[(3 - b) * 3:(4 - b) * 3]), b)
    handle(_events(spark, rows[:3]), 3)      # replay of batch 3: no change
    assert sorted(map(tuple, ledger.public_ledger(read_ledger(spark, path)).collect())) == full
    rewrite_table(spark, path, folded, lambda df: ledger.fold_ledger_rows(df.drop("batch_id")))
    assert sorted(map(tuple, ledger.public_ledger(read_ledger(spark, folded)).collect())) == full


def test_failed_task_keeps_its_traceback(spark):
    ev = _events(spark, [("t1", "n", "FAILURE", T0, None, None, None, "boom", 1),
                         ("t2", "n", "RETRY", T0, None, None, None, "again", 2)])
    led = ledger.fold_task_ledger(ev.withColumn("traceback", F.lit("line 1")))
    req = spark.createDataFrame([("t1",), ("t2",)], "task_id string")
    out = {r.task_id: r for r in ledger.task_status_lookup(req, led).collect()}
    assert out["t1"].traceback == "line 1" and out["t1"].error == "boom"
    assert out["t2"].traceback is None


def test_ids_tell_nulls_and_separators_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a:b", "c"), ("a", "b:c"), ("a", "\u0001")],
                               "x string, y string")
    assert df.select(row_id(["x", "y"]).alias("i")).distinct().count() == 5
    assert ledger.bulk_dispatch(df, ["x", "y"]).select("task_id").distinct().count() == 5


def test_status_lookup_progress(spark):
    led = ledger.fold_task_ledger(_events(spark, [
        ("t1", "n", "STARTED", T0, None, None, None, None, 1),
        ("t2", "n", "SUCCESS", T0, None, None, "ok", None, 2)]))
    pts = spark.createDataFrame([("t1", 1, 500, 3), ("t1", 11, 500, 3), ("t2", 500, 500, 0)],
                                "task_id string, current int, total int, chunk_id long")
    req = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "task_id string")
    out = {r.task_id: r for r in ledger.task_status_lookup(
        req, led, progress=ledger.latest_progress(pts)).collect()}
    assert (out["t1"].state, out["t1"].current, out["t1"].total, out["t1"].chunk_id) == \
        ("PROGRESS", 11, 500, 3)
    assert out["t1"].message == "Task is currently being processed" and not out["t1"].ready
    assert out["t2"].state == "SUCCESS" and out["t2"].result == "ok"
    assert out["t3"].state == "PENDING" and out["t3"].total == 1


def test_result_ttl_cutoff(spark):
    df = spark.createDataFrame([(1, T0), (2, T0 + dt.timedelta(minutes=59))],
                               "id int, created_at timestamp_ntz")
    as_of = F.lit(T0 + dt.timedelta(hours=1)).cast("timestamp_ntz")
    cut = ledger.retention_cutoff(as_of, seconds=3600)
    assert [r.id for r in ledger.retained(df, "created_at", cut).collect()] == [1, 2]
    cut2 = ledger.retention_cutoff(as_of + F.expr("INTERVAL 2 MINUTES"), seconds=3600)
    assert [r.id for r in ledger.retained(df, "created_at", cut2).collect()] == [2]


def test_fold_hot_task_is_partially_aggregated(spark):
    """One task holds a third of all events: the fold stays correct and the
    plan keeps a map-side partial aggregate before the shuffle."""
    n = 3000
    ev = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
         .alias("task_id"),
        F.lit("job").alias("task_name"),
        F.when(F.col("id") == n - 3, F.lit("SUCCESS")).otherwise(F.lit("RETRY")).alias("status"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_interval(secs=F.col("id").cast("int")))
         .alias("updated_at"),
        F.col("id").cast("string").alias("args"), F.lit(None).cast("string").alias("kwargs"),
        F.when(F.col("id") == n - 3, F.lit("done")).alias("result"),
        F.when(F.col("id") < n - 3, F.concat(F.lit("e"), F.col("id").cast("string")))
         .alias("error"),
        F.col("id").alias("event_seq")).repartition(6)
    folded = ledger.fold_task_ledger(ev)
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    hot = ledger.public_ledger(folded).filter("task_id = 'hot'").first()
    assert (hot.status, hot.result, hot.error, hot.args) == ("SUCCESS", "done", "e2994", "2997")
    assert folded.count() == 1 + 2 * n // 3


def test_update_and_delete_keep_nulls(spark):
    paths = [scratch_path(spark, "t") for _ in range(3)]
    spark.createDataFrame([(1, "O"), (2, "F"), (3, None)], "id int, s string").write.parquet(paths[0])
    rewrite_table(spark, paths[0], paths[1],
                  lambda df: ledger.update_where(df, F.col("s") == "O", {"s": F.lit("F")}))
    out = rewrite_table(spark, paths[1], paths[2], lambda df: ledger.delete_where(df, F.col("id") == 2))
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "F"), (3, None)]
    assert ledger.delete_where(out, F.col("s") == "F").count() == 1


def test_sweep_on_day_partitioned_table_prunes(spark):
    df = spark.createDataFrame([(i, T0 + dt.timedelta(days=i)) for i in range(10)],
                               "id int, created_at timestamp_ntz").withColumn(
        "day", F.to_date("created_at"))
    src, dst = scratch_path(spark, "day"), scratch_path(spark, "day")
    df.write.partitionBy("day").parquet(src)
    cutoff = F.lit(dt.date(2024, 1, 6))
    kept = ledger.retained(spark.read.parquet(src), "day", cutoff)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day#" in plan.split("PartitionFilters: [")[1][:200]
    out = rewrite_table(spark, src, dst, lambda d: ledger.retained(d, "day", cutoff), ["day"])
    assert sorted(r.id for r in out.collect()) == [5, 6, 7, 8, 9]
