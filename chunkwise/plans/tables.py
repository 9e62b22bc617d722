"""Driver tables and the stand-in mappings used by the catalog.

The record contract (persons, mails, jobs, task events) is bound to the
driver's TPC-H-like tables; these helpers build those stand-in frames so
the Spark side and the SQL oracle use the same definitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ntz(text: str) -> Column:
    """A TIMESTAMP_NTZ literal (the driver tables are time-zone free)."""
    return F.lit(text).cast("timestamp_ntz")


# Fixed mapping of event types to task states for the task-ledger stand-in.
EVENT_TASK_STATUS = {"view": "STARTED", "signup": "PENDING", "purchase": "SUCCESS",
                     "error": "FAILURE", "click": "RETRY"}


def task_events(events: DataFrame) -> DataFrame:
    """events -> task events: task = user, status from the event type; a
    purchase carries a result, an error or a click (retry) an error text."""
    status = F.lit(None).cast("string")
    for k, v in reversed(list(EVENT_TASK_STATUS.items())):
        status = F.when(F.col("event_type") == k, F.lit(v)).otherwise(status)
    et = F.col("event_type")
    return events.select(
        F.col("user_id").cast("string").alias("task_id"),
        F.concat(F.lit("job."), et).alias("task_name"),
        status.alias("status"),
        F.col("ts").alias("updated_at"),
        F.col("value").cast("string").alias("args"),
        F.col("props").alias("kwargs"),
        F.when(et == "purchase", F.col("props")).alias("result"),
        F.when(et.isin("error", "click"), F.col("props")).alias("error"),
        F.when(et == "error", F.concat(F.lit("trace of "), F.col("props"))).alias("traceback"),
        F.col("event_id").alias("event_seq"),
    )


TASK_EVENTS_SQL = """
SELECT CAST(user_id AS VARCHAR) AS task_id,
       'job.' || event_type AS task_name,
       CASE event_type WHEN 'view' THEN 'STARTED' WHEN 'signup' THEN 'PENDING'
            WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILURE'
            WHEN 'click' THEN 'RETRY' END AS status,
       ts AS updated_at,
       CAST(value AS VARCHAR) AS args,
       props AS kwargs,
       CASE WHEN event_type = 'purchase' THEN props END AS result,
       CASE WHEN event_type IN ('error', 'click') THEN props END AS error,
       CASE WHEN event_type = 'error' THEN 'trace of ' || props END AS traceback,
       event_id AS event_seq
FROM events
"""

LEDGER_SQL = f"""
WITH ev AS ({TASK_EVENTS_SQL})
SELECT task_id,
       arg_max(task_name, struct_pack(t := updated_at, s := event_seq)) AS task_name,
       arg_max(status, struct_pack(t := updated_at, s := event_seq)) AS status,
       max(updated_at) AS updated_at,
       arg_max(args, struct_pack(t := updated_at, s := event_seq)) AS args,
       arg_max(kwargs, struct_pack(t := updated_at, s := event_seq)) AS kwargs,
       arg_max(result, struct_pack(t := updated_at, s := event_seq))
           FILTER (WHERE result IS NOT NULL) AS result,
       arg_max(error, struct_pack(t := updated_at, s := event_seq))
           FILTER (WHERE error IS NOT NULL) AS error,
       arg_max(traceback, struct_pack(t := updated_at, s := event_seq))
           FILTER (WHERE traceback IS NOT NULL) AS traceback
FROM ev GROUP BY task_id
"""
