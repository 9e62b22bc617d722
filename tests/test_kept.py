"""Stored tables: changed by partition, appended once, kept by key, looked up by point."""

import datetime as dt
import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from chunkwise.operators import ledger
from chunkwise.plans.tables import table, task_events
from chunkwise.session import local_path, scratch_path
from chunkwise.sources import read_json_objects, read_json_records, write_bucketed, write_for_lookup
from chunkwise.sources.counted import counting
from chunkwise.sources.daily import (change_days, delete_days, drop_days, stored_days, sweep_days,
                                     update_days, write_by_day)
from chunkwise.sources.jsonarray import array_elements
from chunkwise.sources.once import append_once, read_once, write_once

from conftest import SF_SMALL

DAY0 = dt.datetime(2024, 3, 1)


def _by_day(spark, n=240):
    rows = [(i, DAY0 + dt.timedelta(hours=3 * i) if i % 40 else None, i % 5) for i in range(n)]
    path = scratch_path(spark, "by-day")
    write_by_day(spark.createDataFrame(rows, "id long, ts timestamp_ntz, v int"), path, "ts")
    return path, rows


def _files(path):
    return {f: os.stat(f).st_mtime_ns
            for f in glob.glob(f"{local_path(path)}/day=*/*.parquet")}


def _held(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("id", "ts", "v")
                  .orderBy("id").collect())


def _day_of(file):
    return file.split("day=")[1].split("/")[0]


def test_sweep_drops_days_and_leaves_the_others_files(spark):
    path, rows = _by_day(spark)
    before, cutoff = _files(path), DAY0 + dt.timedelta(days=10, hours=7)
    swept = sweep_days(spark, path, "ts", cutoff)
    gone = [r for r in rows if r[1] is not None and r[1] < cutoff]
    assert swept["deleted"] == len(gone)
    assert swept["dropped_days"] == [(DAY0 + dt.timedelta(days=k)).date() for k in range(10)]
    assert swept["days"] == [cutoff.date()]
    assert _held(spark, path) == sorted(r for r in rows if r not in gone)
    after = _files(path)
    later = {f for f in before if _day_of(f) > "2024-03-11"}     # and the rows without a day
    assert len(later) == 20 and all(after[f] == before[f] for f in later)
    assert sweep_days(spark, path, "ts", cutoff)["deleted"] == 0      # again: nothing to do
    assert _files(path) == after


def test_update_and_delete_rewrite_matching_days_only(spark):
    path, rows = _by_day(spark)
    before = _files(path)
    hit = (F.col("id") >= 16) & (F.col("id") < 28) & (F.col("v") == 2)
    done = update_days(spark, path, hit, {"v": F.lit(9)})
    want = [(i, t, 9 if 16 <= i < 28 and v == 2 else v) for i, t, v in rows]
    assert done["matching"] == 3 and _held(spark, path) == sorted(want)
    days = {str(d) for d in done["days"]}
    assert days == {str(rows[i][1].date()) for i in (17, 22, 27)}
    after = _files(path)
    assert all(after[f] == m for f, m in before.items() if _day_of(f) not in days)
    assert update_days(spark, path, F.col("id") < 0, {"v": F.lit(1)}) == {"matching": 0, "days": []}
    # a delete that empties one day, a null predicate that keeps its row
    gone = F.col("ts").cast("date") == F.lit(dt.date(2024, 3, 5))
    delete_days(spark, path, gone)
    assert dt.date(2024, 3, 5) not in stored_days(spark, path) and None in stored_days(spark, path)
    assert _held(spark, path) == sorted(r for r in want if r[1] is None or r[1].date() != dt.date(2024, 3, 5))
    with pytest.raises(ValueError):
        update_days(spark, path, gone, {"day": F.lit(None)})


def test_a_failed_change_leaves_the_table(spark):
    path, rows = _by_day(spark)
    before = _files(path)
    with pytest.raises(Exception):
        change_days(spark, path, F.col("id") < 30, lambda df: df.withColumn(
            "v", F.when(F.col("id") == 5, F.raise_error(F.lit("no"))).otherwise(F.col("v")).cast("int")))
    assert _files(path) == before
    drop_days(spark, path, [dt.date(1999, 1, 1)])
    assert _files(path) == before


# ------------------------------------------------------------------- append once
def _orders(spark):
    return table(spark, SF_SMALL, "orders").select("o_orderkey", "o_orderstatus")


def test_append_once_after_a_failure_and_twice(spark):
    o, path = _orders(spark).repartition(4), scratch_path(spark, "once")
    n = o.count()
    last = o.agg(F.max("o_orderkey")).first()[0]
    broken = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("lost")))
                          .otherwise(F.col("o_orderstatus")).cast("string"))
    with pytest.raises(Exception):
        append_once(broken, path, ["o_orderkey"], "run", 0)
    assert read_once(spark, path, o.schema).count() == 0        # nothing of it is seen
    for _ in range(2):
        got = append_once(o, path, ["o_orderkey"], "run", 0)
        assert got.count() == n and got.select("row_id").distinct().count() == n
        assert got.select("created_at").distinct().count() == 1
    assert append_once(o, path, ["o_orderkey"], "run", 1).count() == 2 * n       # another batch
    assert append_once(o.limit(0), path, ["o_orderkey"], "empty", 0).count() == 2 * n
    # files on disk: those of the manifests; a second commit took its own away
    files = glob.glob(f"{local_path(path)}/data/run/1/*.parquet")
    listed = [json.loads(x) for x in open(f"{local_path(path)}/_commits/run-1.json")]
    assert sorted(os.path.basename(f) for f in files) == sorted(os.path.basename(x["file"]) for x in listed)
    assert sum(x["rows"] for x in listed) == n


def test_once_as_a_stream_sink(spark):
    """A batch that is replayed under its id is in the table once."""
    path, o = scratch_path(spark, "once-stream"), _orders(spark)
    for batch in (0, 1, 1, 0):
        write_once(o.filter(F.col("o_orderkey") % 2 == batch), path, "stream", batch)
    got = read_once(spark, path, o.schema)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, o.collect()))
    with pytest.raises(Exception):
        write_once(o, path, "no/slashes", 0)


# ------------------------------------------------------------------- kept by key
def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_upsert_shuffles_new_events_only(spark):
    ev = task_events(table(spark, SF_SMALL, "events"))
    parts = [ev.filter(F.col("event_seq") % 3 == k) for k in range(3)]
    stored = write_bucketed(ledger.fold_task_ledger(parts[0]), scratch_path(spark, "b"), "task_id", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for part in parts[1:]:
            merged = ledger.upsert_by_key(stored, ledger.fold_task_ledger(part))
            plan = _final_plan(merged)
            stored = write_bucketed(merged, scratch_path(spark, "b"), "task_id", 8)
            lines = plan.splitlines()
            scan = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
            depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
            at = scan       # from the ledger's scan up to the join: no exchange
            for i in range(scan - 1, -1, -1):
                if depth[i] < depth[at]:
                    at = i
                    if "Join" in lines[i]:
                        break
                    assert "Exchange" not in lines[i] and "ShuffleQueryStage" not in lines[i], plan
            assert "Join" in lines[at]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    a, b = (sorted(map(tuple, ledger.public_ledger(x).collect()), key=str)
            for x in (stored, ledger.fold_task_ledger(ev)))
    assert a == b


def test_upsert_of_ties_and_nulls(spark):
    """Any split of the events and any order of upserts gives the fold."""
    rng = random.Random(1)
    rows = [(f"t{rng.randint(0, 5)}", "n", rng.choice(["SUCCESS", "RETRY"]), DAY0 + dt.timedelta(hours=rng.randint(0, 3)),
             "a", None, rng.choice([None, "r"]), rng.choice([None, "e"]), None, k) for k in range(60)]
    schema = ("task_id string, task_name string, status string, updated_at timestamp_ntz, args string, "
              "kwargs string, result string, error string, traceback string, event_seq long")
    ev = spark.createDataFrame(rows, schema)
    want = sorted(map(tuple, ledger.public_ledger(ledger.fold_task_ledger(ev)).collect()))
    for k in (10, 30, 55):
        a, b = (ledger.fold_task_ledger(ev.filter(c)) for c in (F.col("event_seq") < k, F.col("event_seq") >= k))
        for x, y in ((a, b), (b, a)):
            assert sorted(map(tuple, ledger.public_ledger(ledger.upsert_by_key(x, y)).collect())) == want


def _rows_read(df):
    """Rows that the scan of the executed plan gave out (whole row groups)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_a_point_lookup_skips_row_groups(spark):
    """Min/max values rule out all but one group; where every group spans the id, the Bloom
    filters do."""
    n = 40_000
    rows = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("task_id"), F.col("id").alias("v"))
    spark.conf.set("parquet.block.size", str(64 << 10))
    spark._jsc.hadoopConfiguration().set("parquet.block.size", str(64 << 10))
    try:
        path = scratch_path(spark, "lookup")
        write_for_lookup(rows, path, "task_id", 2000)
        # the same rows unsorted: every group's values span nearly all ids
        mixed = scratch_path(spark, "lookup-mixed")
        (rows.coalesce(1).write.option("parquet.bloom.filter.enabled#task_id", "true")
         .option("parquet.bloom.filter.expected.ndv#task_id", "2000").parquet(mixed))
    finally:
        spark.conf.unset("parquet.block.size")
        spark._jsc.hadoopConfiguration().unset("parquet.block.size")
    asked = rows.filter("v = 12345").first()["task_id"]
    for p in (path, mixed):
        hit = spark.read.parquet(p).filter(F.col("task_id") == asked)
        assert [r["v"] for r in hit.collect()] == [12345]
        assert 0 < _rows_read(hit) < n / 4
        assert _rows_read(spark.read.parquet(p).filter(F.col("task_id") == "f" * 31 + "x")) < n / 10


# --------------------------------------------------------------------- counts
def test_counts_are_those_of_the_write(spark):
    df, counts = counting(spark.range(100), even=F.col("id") % 2 == 0, none=F.lit(None).cast("boolean"))
    out = scratch_path(spark, "counted")
    df.filter("id < 10").write.parquet(out)     # rows left out are counted all the same
    assert counts() == {"even": 50, "none": 0}
    assert spark.read.parquet(out).count() == 10


def test_split_counts_in_one_scan(spark):
    from chunkwise.functions import one_of
    from chunkwise.operators import validate
    reads = spark.sparkContext.accumulator(0)

    def through(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    o = _orders(spark)
    n, bad = o.count(), o.filter("o_orderstatus = 'P'").count()
    checked = validate.with_errors(o.mapInArrow(through, o.schema), [one_of("o_orderstatus", ("O", "F"))])
    paths, counts = validate.write_split_counted(checked, scratch_path(spark, "split"))
    assert counts == {"valid": n - bad, "rejected": bad} and reads.value == n
    assert spark.read.parquet(paths["rejected"]).count() == bad


# ------------------------------------------------------------------ JSON arrays
def _value(rng, depth=0):
    k = rng.random()
    if k < 0.4:
        return "".join(rng.choice('ab{}[],:"\\ \n\té') for _ in range(rng.randint(0, 12)))
    if k < 0.6:
        return rng.choice([None, True, rng.randint(-9, 10**6), rng.random()])
    if k < 0.8 and depth < 3:
        return {f"k{i}": _value(rng, depth + 1) for i in range(rng.randint(0, 3))}
    return [_value(rng, depth + 1) for _ in range(rng.randint(0, 3))] if depth < 3 else 1


def _write(spark, name, text):
    path = local_path(scratch_path(spark, "json-array"))
    os.makedirs(path)
    with open(f"{path}/{name}", "w") as f:
        f.write(text)
    return path


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("indent", [None, 2])
def test_array_elements_whatever_strings_hold(spark, small_splits, indent):
    rng = random.Random(indent)
    items = [{f"f{i}": _value(rng) for i in range(rng.randint(0, 4))} for _ in range(1500)]
    path = _write(spark, "a.json", json.dumps(items, indent=indent, ensure_ascii=bool(indent)))
    with open(f"{path}/b.json", "w") as f:
        json.dump(items[:7], f)
    got = {}
    for r in array_elements(spark, path).collect():
        got.setdefault(os.path.basename(r["file"]), {})[r["item_index"]] = json.loads(r["raw"])
    assert got == {"a.json": dict(enumerate(items)), "b.json": dict(enumerate(items[:7]))}


def test_a_large_array_is_read_by_several_tasks(spark):
    """Above 2 MB: as the same records in lines, in several tasks."""
    ev = table(spark, SF_SMALL, "events").toPandas()
    items = [{"event_id": int(i), "props": p * 60} for i, p in zip(ev["event_id"], ev["props"])] * 4
    text = json.dumps(items)
    assert len(text) > 2 << 20
    path = _write(spark, "a.json", text)
    lines = _write(spark, "a.jsonl", "\n".join(map(json.dumps, items)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        scan = spark.read.option("lineSep", "}").text(path)
        assert scan.rdd.getNumPartitions() >= 4
        schema = "event_id long, props string"
        from pyspark.sql.types import StructType
        a = read_json_records(spark, path, StructType.fromDDL(schema), array_file=True)
        b = read_json_records(spark, lines, StructType.fromDDL(schema))
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_malformed_elements_are_kept(spark):
    path = _write(spark, "m.json", '[1, "a,{b", {"x":1}, {"y":"}{"} , null, {"z": }, {"t":{"u":[{"v":1},2]}},\n {"open":1')
    rows = read_json_objects(spark, path, array_file=True).orderBy("item_index").collect()
    assert [(r["item_index"], r["raw"]) for r in rows] == list(enumerate(
        ["1", '"a,{b"', '{"x":1}', '{"y":"}{"}', "null", '{"z": }', '{"t":{"u":[{"v":1},2]}}', '{"open":1']))
    assert [r["item_index"] for r in rows if r["record"] is not None] == [2, 3, 6]
    from pyspark.sql.types import StructType
    kept = read_json_records(spark, path, StructType.fromDDL("x long"), array_file=True, corrupt_col="bad")
    assert kept.filter("x = 1").count() == 1 and kept.filter("bad is not null").count() >= 3
    for text in ("[]", "", " [ ] "):
        assert array_elements(spark, _write(spark, "e.json", text)).collect() == []
