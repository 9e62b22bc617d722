"""Completed-event messages.

An event row is ``(topic, key, value, headers, content_type, delivery_mode,
timestamp)``; ``value`` is the JSON body, ``headers`` a string map.  The
frame is written as JSON lines, or to Kafka when its connector is on the
classpath (not bundled here).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def build_events(df: DataFrame, body: Mapping[str, Column], queue: str, run_id: str,
                 event_type: str = "task_completed", producer: str = "chunkwise",
                 attempt: int = 1, routing_key: str | None = None,
                 timestamp: Column | None = None) -> DataFrame:
    """One message per input row.  The body holds ``event`` and ``run_id``
    first, then the given fields; the routing key defaults to the queue."""
    fields = [F.lit(event_type).alias("event"), F.lit(run_id).alias("run_id")]
    fields += [v.alias(k) for k, v in body.items()]
    headers = F.create_map(
        F.lit("producer"), F.lit(producer),
        F.lit("run_id"), F.lit(run_id),
        F.lit("event_type"), F.lit(event_type),
        F.lit("attempt"), F.lit(str(attempt)),
    )
    return df.select(
        F.lit(queue).alias("topic"),
        F.lit(routing_key or queue).alias("key"),
        # null fields are written as null, as a JSON encoder of a dict would
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
        headers.alias("headers"),
        F.lit("application/json").alias("content_type"),
        F.lit(2).alias("delivery_mode"),
        (timestamp if timestamp is not None else F.current_timestamp()).alias("timestamp"),
    )


def completed_event(combined: DataFrame, sample: DataFrame, sample_col: str, run_id: str,
                    task_id: str, model_name: str, data_path: str, completed_at: Column,
                    queue: str, status: str = "completed") -> DataFrame:
    """The run's one completed event, from the job roll-up (one row) and a bounded sample
    in job order: ``data`` holds the output's path and the sample, never the payload."""
    values = sample.agg(F.transform(F.sort_array(F.collect_list(
        F.struct("chunk_id", "item_index", F.col(sample_col).cast("string").alias("v")))),
        lambda s: s["v"]).alias("_sample"))
    return build_events(combined.crossJoin(values), {
        "status": F.lit(status), "task_id": F.lit(task_id), "total_chunks": F.col("total_chunks"),
        "item_count": F.col("total_items"),
        "average_processing_time": F.col("avg_processing_time"),
        "model_name": F.lit(model_name),
        "data": F.struct(F.lit(data_path).alias("path"), F.col("_sample").alias("sample")),
        "completed_at": F.date_format(completed_at, "yyyy-MM-dd'T'HH:mm:ss"),
    }, queue=queue, run_id=run_id)


def publish_events(events: DataFrame, path: str | None = None,
                   kafka_options: Mapping[str, str] | None = None, mode: str = "append") -> None:
    """Write events: Kafka when ``kafka_options`` are given (needs the
    connector jar), else JSON lines under ``path``."""
    if kafka_options:
        hdr = F.transform(F.map_entries("headers"), lambda e: F.struct(
            e["key"].alias("key"), e["value"].cast("binary").alias("value")))
        (events.select("topic", "key", "value", hdr.alias("headers"))
               .write.format("kafka").options(**kafka_options).save())
        return
    if path is None:
        raise ValueError("path or kafka_options required")
    events.write.mode(mode).json(path)
