"""Bindings for stored tables: changed by partition, appended once, kept by key, looked up by
point, and JSON arrays read in parallel (S2, S4, L1, L4-L6, L8)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkwise.operators import ledger
from chunkwise.plans.catalog import EVENTS_SCHEMA, register
from chunkwise.plans.tables import LEDGER_SQL, ntz, table, task_events
from chunkwise.session import scratch_path
from chunkwise.sources import read_json_records, write_bucketed, write_for_lookup
from chunkwise.sources.daily import delete_days, sweep_days, update_days, write_by_day
from chunkwise.sources.once import append_once

_SWEEP_AT = dt.datetime(2024, 2, 15, 7, 30) - dt.timedelta(days=30)
LEDGER_BUCKETS = 16


def _events_by_day(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "events-by-day")
    write_by_day(table(spark, d, "events"), path, "ts")
    return path


@register("retention_by_day", """
SELECT event_id, ts, (SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-01-16 07:30:00') AS deleted
FROM events WHERE NOT coalesce(ts < TIMESTAMP '2024-01-16 07:30:00', false)
""")
def q_retention_by_day(spark: SparkSession, d: str) -> DataFrame:
    """L6 on a table by day: expired days are dropped unread, the cutoff's day is rewritten,
    and every survivor comes with the number of rows that went."""
    path = _events_by_day(spark, d)
    swept = sweep_days(spark, path, "ts", _SWEEP_AT)
    return spark.read.parquet(path).select("event_id", "ts", F.lit(swept["deleted"]).cast("long").alias("deleted"))


@register("update_by_day", """
SELECT event_id, ts, CASE WHEN event_type = 'error' AND ts >= TIMESTAMP '2024-01-10'
                               AND ts < TIMESTAMP '2024-01-12' THEN 0.0 ELSE value END AS value
FROM events
""")
def q_update_by_day(spark: SparkSession, d: str) -> DataFrame:
    """L4 on a table by day: an update whose rows lie in two days rewrites those two."""
    path = _events_by_day(spark, d)
    rows = (F.col("event_type") == "error") & (F.col("ts") >= ntz("2024-01-10 00:00:00")) \
        & (F.col("ts") < ntz("2024-01-12 00:00:00"))
    update_days(spark, path, rows, {"value": F.lit(0.0)})
    return spark.read.parquet(path).select("event_id", "ts", "value")


@register("delete_by_day", """
SELECT event_id, ts FROM events
WHERE NOT coalesce(event_type = 'click' AND ts < TIMESTAMP '2024-01-05', false)
""")
def q_delete_by_day(spark: SparkSession, d: str) -> DataFrame:
    """L5 on a table by day: a delete within the first days leaves the others' files alone."""
    path = _events_by_day(spark, d)
    delete_days(spark, path, (F.col("event_type") == "click")
                & (F.col("ts") < ntz("2024-01-05 00:00:00")))
    return spark.read.parquet(path).select("event_id", "ts")


@register("periodic_sweep", """
SELECT o_orderkey, o_orderdate,
       (SELECT count(*) FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' - INTERVAL 30 DAY) AS deleted
FROM orders WHERE NOT coalesce(o_orderdate < TIMESTAMP '1999-01-01' - INTERVAL 30 DAY, false)
""")
def q_periodic_sweep(spark: SparkSession, d: str) -> DataFrame:
    """The number of rows that a sweep deletes, observed in the write of the survivors."""
    from chunkwise.plans.jobs import sweep_table
    path = scratch_path(spark, "orders-kept")
    deleted = sweep_table(spark, f"{d}/orders.parquet", path, "o_orderdate",
                          ledger.retention_cutoff(ntz("1999-01-01 00:00:00")))
    return spark.read.parquet(path).select("o_orderkey", "o_orderdate",
                                           F.lit(deleted).cast("long").alias("deleted"))


@register("append_once", """
SELECT o_orderkey, o_orderstatus, md5('{"o_orderkey":"' || o_orderkey || '"}') AS row_id,
       TIMESTAMP '2024-01-01' AS created_at
FROM orders
""")
def q_append_once(spark: SparkSession, d: str) -> DataFrame:
    """S4 exactly once: finished orders, the rest, and both again under the same run and
    batches: one copy of each."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    done = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    path = scratch_path(spark, "orders-once")
    for _ in range(2):
        for batch, rows in enumerate((o.filter(done), o.filter(~done))):
            out = append_once(rows, path, ["o_orderkey"], "run-0001", batch,
                              created_at=ntz("2024-01-01 00:00:00"))
    return out.select("o_orderkey", "o_orderstatus", "row_id", "created_at")


@register("task_ledger_bucketed", LEDGER_SQL)
def q_task_ledger_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """L1 upsert into a ledger stored by key: only the new events are shuffled."""
    ev = task_events(table(spark, d, "events"))
    early = F.coalesce(F.col("updated_at") < ntz("2024-01-15 00:00:00"), F.lit(False))
    stored = write_bucketed(ledger.fold_task_ledger(ev.filter(early)), scratch_path(spark, "ledger-by-key"),
                            "task_id", LEDGER_BUCKETS)
    merged = ledger.upsert_by_key(stored, ledger.fold_task_ledger(ev.filter(~early)))
    return ledger.public_ledger(write_bucketed(merged, scratch_path(spark, "ledger-by-key"), "task_id",
                                               LEDGER_BUCKETS))


@register("task_status_point", f"""
WITH led AS ({LEDGER_SQL}),
asked AS (SELECT CAST(arg_max(user_id, struct_pack(t := ts, e := event_id)) AS VARCHAR) AS task_id FROM events
          UNION ALL SELECT 'no such task')
SELECT a.task_id, coalesce(l.status, 'PENDING') AS state,
       CASE WHEN l.status = 'SUCCESS' THEN l.result END AS result,
       CASE WHEN l.status IN ('FAILURE', 'RETRY') THEN l.error END AS error
FROM asked a LEFT JOIN led l ON a.task_id = l.task_id
""")
def q_task_status_point(spark: SparkSession, d: str) -> DataFrame:
    """L8 for one id (that of the latest event) and one that is unknown, from a ledger
    sorted by id with Bloom filters: what can't hold the ids is not read."""
    events = table(spark, d, "events")
    asked = events.agg(F.max_by("user_id", F.struct("ts", "event_id")).cast("string")
                       .alias("task_id")).first()["task_id"]
    path = scratch_path(spark, "ledger-lookup")
    folded = ledger.fold_task_ledger(task_events(events))
    write_for_lookup(ledger.public_ledger(folded), path, "task_id", n_keys=100_000)
    ids = [asked, "no such task"]
    requests = spark.createDataFrame([(i,) for i in ids], "task_id string")
    found = spark.read.parquet(path).filter(F.col("task_id").isin(ids))
    return ledger.task_status_lookup(requests, found).select("task_id", "state", "result", "error")


@register("json_array_scan", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_json_array_scan(spark: SparkSession, d: str) -> DataFrame:
    """Four files of one JSON array each, read by as many tasks as they have splits."""
    events = table(spark, d, "events")
    body = F.to_json(F.struct(*events.columns), {
        "ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    part = F.pmod(F.xxhash64("event_id"), F.lit(4)).alias("part")
    first = F.row_number().over(Window.partitionBy("part").orderBy("event_id")) == 1
    lines = events.select(part, "event_id", body.alias("body")).select(
        "part", F.lit(1).alias("kind"), "event_id",
        F.concat(F.when(first, F.lit("")).otherwise(F.lit(",")), F.col("body")).alias("value"))
    ends = spark.range(4).select(F.col("id").alias("part"), F.explode(F.array(F.lit(0), F.lit(2))).alias("kind"))
    ends = ends.select("part", "kind", F.lit(None).cast("long").alias("event_id"),
                       F.when(F.col("kind") == 0, F.lit("[")).otherwise(F.lit("]")).alias("value"))
    path = scratch_path(spark, "events-arrays")
    (lines.unionByName(ends).repartition(4, "part").sortWithinPartitions("part", "kind", "event_id")
     .select("part", "value").write.partitionBy("part").text(path))
    return read_json_records(spark, f"{path}/part=*", EVENTS_SCHEMA, array_file=True)
