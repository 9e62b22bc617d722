"""Positional indexer and chunk roll-ups: invariants, skew, empty input."""

import pytest
from pyspark.sql import functions as F

from chunkwise.operators import chunks
from chunkwise.operators.positions import with_position

from conftest import SF_SMALL


def test_positions_dense_under_skew(spark):
    # one value of the leading order column holds a third of the rows
    df = spark.range(0, 3000).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(7))
                                         .otherwise(F.col("id")))
    pos = with_position(df, ["k", "id"], num_partitions=6)
    rows = pos.orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(3000))
    keys = [(r.k, r.id) for r in rows]
    assert keys == sorted(keys)
    # the hot value is split over several range partitions
    from chunkwise.operators.positions import range_layout
    lay = range_layout(df, ["k", "id"], 6)
    per = lay.filter(F.col("k") == 7).groupBy("_cw_pid").count().collect()
    assert len(per) > 1


def test_positions_empty(spark):
    df = spark.range(0).withColumn("k", F.col("id"))
    assert with_position(df, ["k"]).count() == 0


def test_chunk_invariants(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    c = chunks.assign_chunks(o, ["o_orderkey"], 70)
    n = o.count()
    stats = chunks.chunk_stats(c).collect()
    assert sum(r.item_count for r in stats) == n
    assert len(stats) == -(-n // 70)
    assert max(r.item_count for r in stats) == 70
    last = max(stats, key=lambda r: r.chunk_id)
    assert last.item_count == n - 70 * (len(stats) - 1)
    summary = chunks.dispatch_summary(o, 70).first()
    assert summary.total_items == n and summary.chunks == len(stats)


def test_combine_empty_job(spark):
    empty = spark.createDataFrame([], "chunk_id long, item_count long, processing_time double")
    r = chunks.combine_chunks(empty).first()
    assert r.total_chunks == 0 and r.total_items == 0 and r.avg_processing_time == 0.0


def test_progress_points_last_item(spark):
    df = spark.range(0, 25).withColumnRenamed("id", "k")
    c = chunks.assign_chunks(df, ["k"], 12)
    pts = chunks.progress_points(c, 12, throttled=True).orderBy("chunk_id", "current").collect()
    assert [(p.chunk_id, p.current, p.total) for p in pts] == [
        (0, 1, 12), (0, 11, 12), (0, 12, 12), (1, 1, 12), (1, 11, 12), (1, 12, 12), (2, 1, 1)]
    assert pts[-1].percentage == 100.0


def test_prechunked_explode(spark):
    df = spark.createDataFrame([(1, [["a", "b"], ["c"]])], "job int, chunks array<array<string>>")
    rows = chunks.prechunked_explode(df, "chunks", keep=["job"]).collect()
    assert [(r.chunk_id, r.item_index, r.item) for r in rows] == [(0, 0, "a"), (0, 1, "b"),
                                                                  (1, 0, "c")]


def test_no_single_partition_exchange(spark):
    """A1 must not plan ``Exchange SinglePartition`` over the data rows."""
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    c = chunks.assign_chunks(o, ["o_orderkey"], 500)
    plan = c._jdf.queryExecution().executedPlan().toString()
    # the only single-partition exchange allowed is over the <= P offset rows,
    # which sits under the broadcast of the offsets
    assert "BroadcastExchange" in plan


def test_run_chunk_job_writes_everything(spark):
    from chunkwise.plans.jobs import run_chunk_job
    from chunkwise.plans.tables import ntz
    from chunkwise.session import scratch_path
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet").select("p_partkey", "p_name", "p_size")
    root = scratch_path(spark, "job")
    for run in ("run-0", "run-1", "run-1"):          # a repeated run replaces its own rows
        res = run_chunk_job(part, ["p_partkey"], root, run, size=10,
                            duration="p_size", completed_at=ntz("2024-01-01 00:00:00"))
    n = part.count()
    assert res["total_items"] == n and res["total_chunks"] == -(-n // 10)
    out = spark.read.parquet(res["paths"]["output"]).filter("run_id = 'run-1'")
    assert out.count() == n
    assert out.filter(out.p_name != F.upper(out.p_name)).count() == 0
    jobs = spark.read.parquet(res["paths"]["jobs"]).collect()
    assert sorted(j.run_id for j in jobs) == ["run-0", "run-1"]
    assert len({j.row_id for j in jobs}) == 2 and {j.status for j in jobs} == {"completed"}
    ev = spark.read.json(res["paths"]["events"]).filter("run_id = 'run-1'")
    assert ev.filter("topic = 'chunks'").count() == res["total_chunks"]
    import json
    whole = [json.loads(r.value) for r in ev.filter("topic = 'results'").collect()]
    assert len(whole) == 1
    assert {k: whole[0][k] for k in ("event", "status", "run_id", "total_chunks", "item_count")} == {
        "event": "task_completed", "status": "completed", "run_id": "run-1",
        "total_chunks": res["total_chunks"], "item_count": n}
    assert len(whole[0]["data"]["sample"]) == 20 and "run_id=run-1" in whole[0]["data"]["path"]


def test_periodic_sweep_and_health(spark):
    from chunkwise.plans.jobs import periodic
    from chunkwise.plans.tables import ntz
    from chunkwise.session import scratch_path
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    root = scratch_path(spark, "periodic")
    res = periodic({"events": (f"{SF_SMALL}/events.parquet", "ts"),
                    "orders": (f"{SF_SMALL}/orders.parquet", "o_orderdate")},
                   ntz("2024-02-15 00:00:00"), root,
                   health={"tasks": spark.read.parquet(f"{SF_SMALL}/part.parquet"),
                           "task_name_col": "p_name", "emails": ev, "email_ts_col": "ts",
                           "jobs": o, "job_status_col": "o_orderstatus"})
    kept = spark.read.parquet(f"{root}/events").count()
    assert res["cleaned_up"]["events"] + kept == ev.count()
    assert res["cleaned_up"]["orders"] == o.count()
    assert set(res["stats"]) == {"total_tasks", "recent_emails_24h", "active_processing_jobs"}


def test_non_unique_hot_key_is_split(spark):
    """A non-unique order key whose one value holds a third of the rows is
    still spread over several range partitions (tiebreaker), and positions
    stay dense and ordered by the key."""
    from chunkwise.operators.positions import range_layout
    df = spark.range(0, 3000).withColumn(
        "k", F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id"))).drop("id")
    lay = range_layout(df, ["k"], 6)
    assert lay.filter(F.col("k") == 5).select("_cw_pid").distinct().count() > 1
    sizes = [r["count"] for r in lay.groupBy("_cw_pid").count().collect()]
    assert max(sizes) < 1000
    rows = with_position(df, ["k"], num_partitions=6).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(3000))
    assert [r.k for r in rows] == sorted(r.k for r in rows)


def test_clustered_and_null_keys(spark):
    """Unique keys with a very uneven spread, nulls first and NaN last."""
    keys = list(range(0, 2000)) + [10_000_000 + i * 97 for i in range(2000)]
    df = spark.createDataFrame([(k,) for k in keys[::-1]], "k long").repartition(5)
    out = with_position(df, ["k"]).collect()
    assert sorted((r.k, r.pos) for r in out) == [(k, i) for i, k in enumerate(sorted(keys))]
    c = chunks.assign_chunks(df, ["k"], 300)
    assert c.agg(F.max("chunk_id")).first()[0] == (len(keys) - 1) // 300
    df = spark.createDataFrame([(None,), (3.0,), (1.0,), (float("nan"),), (2.0,)], "k double")
    rows = sorted(with_position(df, ["k"]).collect(), key=lambda r: r.pos)
    assert [r.pos for r in rows] == [0, 1, 2, 3, 4]
    assert rows[0].k is None and rows[1].k == 1.0 and rows[3].k == 3.0


def test_concat_keeps_uneven_chunks_apart(spark):
    rows = [(0, i) for i in range(7)] + [(1, i) for i in range(3)] + [(4, 0)]
    df = spark.createDataFrame(rows, "chunk_id long, item_index long")
    out = chunks.concat_ordered(df.filter("item_index % 2 = 0"), df.filter("item_index % 2 = 1"))
    assert [tuple(r) for r in out.orderBy("seq").collect()] == [(*r, i) for i, r in enumerate(rows)]


def test_progress_points_of_uneven_chunks(spark):
    df = spark.createDataFrame([(0, i) for i in range(12)] + [(1, 0)], "chunk_id long, item_index long")
    pts = chunks.progress_points(df.withColumn("total_items", F.lit(13).cast("long")), throttled=True,
                                 stats=chunks.chunk_stats(df))
    assert sorted((r.chunk_id, r.current, r.total) for r in pts.collect()) == \
        [(0, 1, 12), (0, 11, 12), (0, 12, 12), (1, 1, 1)]


def test_job_log_samples_whatever_it_is_given(spark):
    df = spark.range(100).selectExpr("id div 10 as chunk_id", "id % 10 as item_index", "id as v")
    row = chunks.job_log(chunks.chunk_stats(df), df, "job", "v").first()
    import json
    assert json.loads(row.output_data) == {"total_items": 100, "sample": list(range(20))}


def test_chunk_job_modes(spark):
    import duckdb
    from chunkwise.plans.jobs import chunk_job
    path = f"{SF_SMALL}/orders.parquet"
    q = chunk_job(spark, path).first()
    fc = chunk_job(spark, path, size=50, mode="fail_chunk").first()
    con = duckdb.connect()
    want = con.execute(f"""
        WITH c AS (SELECT o_orderstatus, (row_number() OVER (ORDER BY o_orderkey) - 1) // 50 AS ch
                   FROM '{path}'),
        bad AS (SELECT DISTINCT ch FROM c WHERE o_orderstatus NOT IN ('O', 'F'))
        SELECT count(DISTINCT ch), count(*) FROM c WHERE ch NOT IN (SELECT ch FROM bad)""").fetchall()[0]
    assert (fc.total_chunks, fc.total_items) == want
    n_valid = con.execute(f"SELECT count(*) FROM '{path}' WHERE o_orderstatus IN ('O','F')").fetchall()[0][0]
    assert q.total_items == n_valid
    with pytest.raises(Exception):
        chunk_job(spark, path, mode="fail_job").collect()
