"""Structured Streaming jobs.

The queue consumer of the reference becomes a file (or Kafka) stream source;
its ack becomes the streaming checkpoint; a poison message goes to a
quarantine output instead of being requeued forever.  Every sink is
``foreachBatch`` writing under ``batch_id=<n>`` with overwrite, so a batch
replayed after a failure rewrites the same folder (exactly-once effect on
top of at-least-once delivery).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from chunkwise.operators.ledger import fold_ledger_rows, fold_task_ledger
from chunkwise.sources.counted import counting
from chunkwise.sources.parquet import read_if_exists
from chunkwise.streaming.state import rocksdb_state

CORRUPT = "_corrupt_record"


# --------------------------------------------------------------------------- S8
def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of a folder or glob with a declared schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None
                 ) -> DataFrame:
    """Kafka source (needs the Kafka connector jar, not bundled here): the
    message body as ``body`` text, headers as ``MAP<STRING,STRING>``.
    ``maxOffsetsPerTrigger`` plays the role of the consumer prefetch."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting_offsets)
              .option("includeHeaders", "true"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    raw = reader.load()
    headers = F.map_from_entries(F.transform(F.col("headers"), lambda h: F.struct(
        h["key"], h["value"].cast("string"))))
    return raw.select(F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("body"), headers.alias("headers"),
                      "topic", "partition", "offset", "timestamp")


def decode_body(df: DataFrame, body_col: str, schema: T.StructType,
                out_col: str = "payload") -> DataFrame:
    """``json.loads(body)`` as ``from_json``: adds the decoded struct and a
    ``decoded`` flag.  Malformed text, a null body, a JSON scalar or array,
    or a field of the wrong type give ``decoded = false`` (dead letter); a
    valid object that lacks a field decodes with that field null."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(body_col), with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    out = df.withColumn("_cw_parsed", parsed)
    ok = F.col(body_col).isNotNull() & F.col(f"_cw_parsed.{CORRUPT}").isNull()
    return out.withColumn(out_col, F.when(ok, F.struct(*[
        F.col(f"_cw_parsed.{f.name}").alias(f.name) for f in schema.fields])))\
              .withColumn("decoded", ok).drop("_cw_parsed")


# ------------------------------------------------------------------- plumbing
def batch_sink(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: ``<path>/batch_id=<n>``, overwrite (idempotent)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")
    return write


class _BatchRows(StreamingQueryListener):
    """Input rows of every micro-batch of a query (Spark's own list keeps the last ones only)."""

    def __init__(self):
        self.query, self.rows = None, {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        if p.numInputRows:
            self.rows.setdefault(str(p.runId), {})[p.batchId] = p.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def run_available_now(stream: DataFrame, handler: Callable[[DataFrame, int], dict | None],
                      checkpoint: str, name: str | None = None, timers: bool = False
                      ) -> list[dict]:
    """Process everything available, then stop (the ``availableNow`` trigger).
    Returns the progress of every micro-batch (see ``progress_points``).

    A handler may return the counts of its batch (of an observed write, see ``counting``);
    they join the batch's progress record, and ``rows`` among them is the batch's number of
    rows.  Without it that is Spark's own count of input rows, which counts a batch once for
    each time it is evaluated: a handler that evaluates its batch more than once returns
    ``rows``.

    ``timers``: the stream keeps processing-time timers.  Spark runs empty batches for such a
    stream for ever, so it would never be through; here timers that are due fire with the
    next batch of data, or in a continuous run of the same checkpoint."""
    listener, spark, counts = _BatchRows(), stream.sparkSession, {}

    def handle(batch: DataFrame, batch_id: int) -> None:
        counts[batch_id] = handler(batch, batch_id) or {}

    spark.streams.addListener(listener)
    try:
        w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint) \
                              .trigger(availableNow=True)
        with rocksdb_state(spark, idle_batches=not timers):
            q = (w.queryName(name) if name else w).start()
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        # events reach listeners a little later than the query's own list
        last = q.lastProgress
        for _ in range(100):
            rows = listener.rows.get(str(q.runId), {})
            if not last or not last.numInputRows or last.batchId in rows:
                break
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(listener)
    return progress_points([{"batch_id": b, "rows": n, **counts.get(b, {})}
                            for b, n in sorted(rows.items())])


def progress_points(progress: list, total: int | None = None) -> list[dict]:
    """Progress of a stream (A9): one ``{batch_id, current, total, percentage}`` record per
    micro-batch, ``current`` being the rows processed so far.  ``progress`` holds a record
    of every batch (``batch_id``, ``rows``), as ``run_available_now`` counts them; further
    counts of a batch stay in its record."""
    out, done = [], 0
    for p in progress:
        done += int(p["rows"])
        rec = {"batch_id": int(p["batch_id"]), "current": done, "total": total}
        rec["percentage"] = round(done / total * 100, 1) if total else None
        rec.update({k: v for k, v in p.items() if k not in ("batch_id", "rows")})
        out.append(rec)
    return out


def read_sink(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """What a sink has written; with ``schema``, empty if it has not written yet."""
    return spark.read.parquet(path) if schema is None else read_if_exists(spark, path, schema)


# --------------------------------------------------------------------------- T2
def ledger_handler(path: str, to_events: Callable[[DataFrame], DataFrame]
                   ) -> Callable[[DataFrame, int], None]:
    """foreachBatch: fold the batch's task events into ``<path>/batch_id=<n>``.  The fold is
    associative, so ``read_ledger`` folds these deltas into the ledger; a replayed batch
    rewrites the same folder.  ``rewrite_table`` folds them into one table when they are many."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        fold_task_ledger(to_events(batch)).write.mode("overwrite").parquet(
            f"{path}/batch_id={batch_id}")
    return handle


def read_ledger(spark: SparkSession, *paths: str) -> DataFrame:
    """The ledger of one or more stored ledgers or folders of deltas."""
    rows = [spark.read.parquet(p).drop("batch_id") for p in paths]
    return fold_ledger_rows(reduce(DataFrame.unionByName, rows))


# --------------------------------------------------------------------------- T3
def quarantine_handler(path: str, body_col: str, schema: T.StructType,
                       dead_rows: Callable[[DataFrame], DataFrame]
                       ) -> Callable[[DataFrame, int], dict]:
    """foreachBatch: each body is decoded once, in one write of the batch to
    ``<path>/batch_id=<n>/outcome=valid`` and ``outcome=dead``.  ``dead_rows`` (e.g.
    ``dead_letter_log``) adds columns to rows; they are null in valid ones.  The counts
    ``rows``, ``valid`` and ``dead`` are observed in that write."""
    def handle(batch: DataFrame, batch_id: int) -> dict:
        decoded = decode_body(batch, body_col, schema)
        names = decoded.columns
        shaped = dead_rows(decoded)
        shaped = shaped.select(*names, *[F.when(~F.col("decoded"), F.col(c)).alias(c)
                                         for c in shaped.columns if c not in names])
        counted, counts = counting(shaped, rows=F.lit(True), valid=F.col("decoded"),
                                   dead=~F.col("decoded"))
        outcome = F.when(F.col("decoded"), F.lit("valid")).otherwise(F.lit("dead"))
        counted.withColumn("outcome", outcome).drop("decoded").write.mode("overwrite") \
               .partitionBy("outcome").parquet(f"{path}/batch_id={batch_id}")
        return counts()
    return handle


def read_outcome(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    """The ``valid`` or ``dead`` rows that ``quarantine_handler`` has written (only their
    folders are read)."""
    return spark.read.parquet(path).filter(F.col("outcome") == outcome).drop("outcome")


# --------------------------------------------------------------------------- T4
def dedupe_batch(df: DataFrame, key: str) -> DataFrame:
    """T4 batch twin: one row per key (redelivered copies are identical, so
    which copy survives does not matter); a hash aggregate on the key."""
    return df.dropDuplicates([key])
