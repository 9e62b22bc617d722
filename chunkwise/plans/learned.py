"""Bindings for the model (F10, F12, F14, F15, E1) and streaming (T1-T4) operators.

A forest's probabilities are not SQL, but the labels it must give are, when the target is a
function of a feature: the model keys learn whether a document is English (of a person:
whether they are female) from labelled rows, with the full forest, and every label is
compared with the SQL.  The streaming bindings are checked against the SQL of the batch
result they must equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.config import FeatureSpec, ModelParams
from chunkwise.operators import ledger, validate
from chunkwise.operators.external import external_model, score_external
from chunkwise.operators.features import clean_training_frame
from chunkwise.operators.model import (TrainResult, load_model, save_model, score_batch,
                                       score_one, tasks_for, train_forest)
from chunkwise.plans.catalog import _SPLIT_SQL, EVENTS_SCHEMA, register
from chunkwise.plans.tables import LEDGER_SQL, ntz, table, task_events
from chunkwise.session import scratch_path
from chunkwise.streaming import (batch_sink, combine_runs, dedupe_stream, file_stream,
                                 ledger_handler, quarantine_handler, read_ledger, read_outcome,
                                 read_sink, run_available_now)

MODEL_SPEC = FeatureSpec(num_vars=("n_chars",), cat_vars=("lang", "source"),
                         target="english", id_col="doc_id")
LANGS = ("de", "en", "es", "fr")
_trained: dict[tuple, TrainResult] = {}
_saved: dict[tuple, str] = {}


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the target; without a quality label, they have none."""
    docs = table(spark, d, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"), "lang", "source")
    out = docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return out.withColumn("english", F.when(F.col("quality").isNotNull(),
                                            (F.lower("lang") == "en").cast("int")))


def trained(spark: SparkSession, d: str, params: ModelParams = ModelParams()) -> TrainResult:
    """E3 on the labelled documents."""
    clean = clean_training_frame(_labelled(spark, d).drop("quality"), MODEL_SPEC, fill_col=None)
    return train_forest(clean, MODEL_SPEC, params)


def forest(spark: SparkSession, d: str) -> TrainResult:
    """The full forest on these tables, trained once in an application."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _trained:
        _trained[key] = trained(spark, d)
    return _trained[key]


def saved_model(spark: SparkSession, d: str) -> str:
    """The forest as its training job saved it: the keys about scoring load it."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _saved:
        _saved[key] = save_model(forest(spark, d).model, scratch_path(spark, "forest"))
    return _saved[key]


def _scoring_frame(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        F.lower("lang").alias("lang"), F.lower("source").alias("source"))


def _checks(scored: DataFrame, label: str = "survived") -> list:
    """The label, and whether the probability lies in [0, 1] and on the label's side."""
    p = F.col("probability")
    return [F.col(label).alias("label"),
            (p.between(0, 1) & ((p > 0.5).cast("int") == F.col(label))).alias("prob_ok")]


_SPLIT_SQL_ENGLISH = _SPLIT_SQL.replace("quality", "english").replace("FROM labels", """FROM (
  SELECT l.doc_id, (lower(lang) = 'en')::INTEGER AS english FROM labels l JOIN documents USING (doc_id)
  WHERE quality IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL AND n_chars IS NOT NULL) l""")


@register("train_forest", f"""
SELECT s.doc_id, (lower(lang) = 'en')::INTEGER AS label, split, true AS prob_ok, 5 AS folds_ok
FROM ({_SPLIT_SQL_ENGLISH}) s JOIN documents USING (doc_id)
""")
def q_train_forest(spark: SparkSession, d: str) -> DataFrame:
    """5-fold forest of 100 trees; every labelled row with its split, labelled by
    the returned model, and the number of folds that order both their parts perfectly."""
    res = forest(spark, d)
    ok = sum(m.get("val_auc") == 1 and m.get("test_auc") == 1 for m in res.fold_metrics)
    pred = score_batch(res.model, res.split, label_col="predicted")
    return pred.select("doc_id", "split", *_checks(pred, "predicted"), F.lit(ok).alias("folds_ok"))


@register("score_batch", """
SELECT doc_id, (lower(lang) = 'en')::INTEGER AS label, true AS prob_ok FROM documents
""")
def q_score_batch(spark: SparkSession, d: str) -> DataFrame:
    """every document scored by the trained processor + forest."""
    out = score_batch(load_model(saved_model(spark, d)), _scoring_frame(spark, d))
    return out.select("doc_id", *_checks(out))


@register("score_single", """
SELECT doc_id, (lower(lang) = 'en')::INTEGER AS label, true AS prob_ok FROM documents
WHERE doc_id = (SELECT min(doc_id) FROM documents)
""")
def q_score_single(spark: SparkSession, d: str) -> DataFrame:
    """one record through the same path (the first document by id)."""
    one = score_one(load_model(saved_model(spark, d)), _scoring_frame(spark, d).orderBy("doc_id"))
    return one.select("doc_id", *_checks(one))


@register("model_roundtrip", """
SELECT doc_id, (lower(lang) = 'en')::INTEGER AS label, true AS same_as_unsaved FROM documents
""")
def q_model_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """processor + forest saved, loaded and scored with, beside the unsaved model."""
    model, docs = forest(spark, d).model, _scoring_frame(spark, d)
    loaded = load_model(save_model(model, scratch_path(spark, "model")), use_cache=False)
    return _same(score_batch(loaded, docs), score_batch(model, docs), "same_as_unsaved")


def _same(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """The labels of two scorings of the documents, and whether they agree."""
    b = b.select(F.col("doc_id").alias("_id"), F.col("probability").alias("_p"),
                 F.col("survived").alias("_y"))
    return a.join(b, F.col("doc_id") == F.col("_id"), "full").select(
        F.coalesce("doc_id", "_id").alias("doc_id"), F.col("survived").alias("label"),
        (F.col("probability").eqNullSafe(F.col("_p")) & F.col("survived").eqNullSafe(F.col("_y")))
        .alias(name))


class Line:
    """A user's own model: a straight line through one feature, kept within [0, 1]."""

    def __init__(self, slope: float, intercept: float):
        self.slope, self.intercept = slope, intercept

    def predict(self, matrix):
        return (self.intercept + self.slope * matrix[:, 0]).clip(0.0, 1.0)


_LINE_SQL = """
SELECT count(*)::DOUBLE AS n, sum(n_chars)::DOUBLE AS sx, sum(quality)::DOUBLE AS sy,
       sum(n_chars * quality)::DOUBLE AS sxy, sum(n_chars * n_chars)::DOUBLE AS sxx
FROM documents JOIN labels USING (doc_id) WHERE n_chars IS NOT NULL AND quality IS NOT NULL
"""


@register("score_external", f"""
WITH line AS (SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope FROM ({_LINE_SQL}) s),
p AS (SELECT doc_id, least(greatest((sy - slope * sx) / n + slope * n_chars, 0.0), 1.0) AS probability
      FROM documents, line)
SELECT doc_id, probability, (probability > 0.5)::INTEGER AS survived FROM p
""")
def q_score_external(spark: SparkSession, d: str) -> DataFrame:
    """F12 with a model that is not Spark's: a least-squares line from numpy, fitted on sums
    that Spark takes over all labelled documents, scores every document in Arrow batches."""
    import numpy as np
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    x, y = F.col("n_chars").cast("long"), F.col("quality").cast("long")
    sums = (docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id")
            .filter(x.isNotNull() & y.isNotNull())
            .agg(F.count(F.lit(1)), F.sum(x), F.sum(y), F.sum(x * y), F.sum(x * x)).first())
    n, sx, sy, sxy, sxx = np.array([v or 0 for v in sums], float)
    slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
    model = external_model(spark, Line(slope, (sy - slope * sx) / n), ["n_chars"])
    return score_external(model, docs).select("doc_id", "probability", "survived")


@register("stream_score", """
SELECT doc_id, (lower(lang) = 'en')::INTEGER AS label, true AS same_as_batch FROM documents
WHERE n_chars IS NOT NULL AND lower(lang) IN ('de', 'en', 'es', 'fr')
""")
def q_stream_score(spark: SparkSession, d: str) -> DataFrame:
    """Documents consumed as a stream, validated and scored.  Each micro-batch is
    validated in one write, partitioned by outcome under the batch id, and its valid rows
    are scored from there, over tasks by their number; the predictions equal batch scoring."""
    from chunkwise.functions import one_of, required
    model = load_model(saved_model(spark, d))
    src = scratch_path(spark, "documents-files")
    table(spark, d, "documents").select("doc_id", "n_chars", "lang", "source") \
        .repartition(4, "doc_id").write.parquet(src)
    stream = file_stream(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=2)
    checked, preds = (scratch_path(spark, n) for n in ("checked", "preds"))

    def handle(batch: DataFrame, batch_id: int) -> dict:
        rows = batch.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"),
                            F.lower("lang").alias("lang"), F.lower("source").alias("source"))
        paths, counts = validate.write_split_counted(
            validate.with_errors(rows, [required("n_chars"), one_of("lang", LANGS)]),
            f"{checked}/batch_id={batch_id}")
        valid = read_sink(spark, paths["valid"], rows.schema)
        score_batch(model, valid.repartition(tasks_for(counts["valid"]))) \
            .select("doc_id", "probability", "survived") \
            .write.mode("overwrite").parquet(f"{preds}/batch_id={batch_id}")
        return {"rows": sum(counts.values()), **counts}

    run_available_now(stream, handle, scratch_path(spark, "ckpt-score"))
    docs = _scoring_frame(spark, d).filter(F.col("n_chars").isNotNull() & F.col("lang").isin(*LANGS))
    return _same(read_sink(spark, preds), score_batch(model, docs), "same_as_batch")


_PERSONS_SQL = """
SELECT 'c' || c_custkey AS person_id, CASE WHEN c_custkey % 50 = 0 THEN 'zz' ELSE 'S' END AS embarked,
       c_custkey % 31 = 0 AS no_age, c_custkey % 2 AS female
FROM customer
"""


@register("predict_run", f"""
SELECT person_id, CASE WHEN embarked = 'zz' OR no_age THEN 'rejected' ELSE 'valid' END AS outcome,
       concat_ws('; ', CASE WHEN no_age THEN 'age: required' END,
                 CASE WHEN embarked = 'zz' THEN 'embarked: must be one of s,c,q' END) AS errors,
       CASE WHEN embarked <> 'zz' AND NOT no_age THEN 'success' END AS status,
       CASE WHEN embarked <> 'zz' AND NOT no_age THEN true END AS prob_ok,
       CASE WHEN embarked <> 'zz' AND NOT no_age THEN female::INTEGER END AS label
FROM ({_PERSONS_SQL}) p
""")
def q_predict_run(spark: SparkSession, d: str) -> DataFrame:
    """Raw person records (derived from the customers) are validated, scored and
    written under a run id, persons, predictions and rejects; what was written is read back."""
    from chunkwise.plans.jobs import predict_run, train
    k = F.col("c_custkey")
    raw = table(spark, d, "customer").select(
        F.concat(F.lit("c"), k.cast("string")).alias("person_id"),
        F.when(k % 2 == 0, F.lit(" Male")).otherwise(F.lit("FEMALE")).alias("sex"),
        F.when(k % 31 != 0, (k % 80).cast("double") + 0.5).alias("age"),
        (k % 3 + 1).alias("pclass"), (k % 4).alias("sibsp"), (k % 5).alias("parch"),
        F.abs("c_acctbal").cast("double").alias("fare"),
        F.when(k % 50 == 0, F.lit("zz")).otherwise(F.lit("S")).alias("embarked"),
        (k % 2).alias("survived"))
    known = raw.filter("embarked = 'S'").withColumn("sex", F.trim("sex"))
    model = train(known, FeatureSpec()).model
    paths = predict_run(model, raw, scratch_path(spark, "predict"), "run-0001",
                        now=ntz("2024-01-01 00:00:00").cast("timestamp"))
    scored = spark.read.parquet(paths["predictions"]).select(
        F.col("data.person_id").alias("_id"), "status",
        F.col("data.probability").between(0, 1).alias("prob_ok"),
        F.col("data.survived").alias("label"))
    checked = spark.read.parquet(paths["checked"])
    return checked.join(scored, F.col("person_id") == F.col("_id"), "left").select(
        "person_id", "outcome", F.array_join("errors", "; ").alias("errors"), "status", "prob_ok",
        "label")


def _event_files(spark: SparkSession, d: str, slices: int = 4, redeliver: bool = False) -> str:
    """The events in ``slices`` spans of time, written one after another, the newest first
    and the oldest last, so a stream meets rows later and later; ``redeliver`` writes all
    of them once more after that."""
    path = scratch_path(spark, "events-files")
    events = table(spark, d, "events")
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / slices
    for k in reversed(range(slices)):
        part = (F.col("ts") >= F.lit(lo + k * step)) if k else F.lit(True)
        if k < slices - 1:
            part = part & (F.col("ts") < F.lit(lo + (k + 1) * step))
        if k == 0:
            part = part | F.col("ts").isNull()
        events.filter(part).write.parquet(f"{path}/part={slices - k}")
    if redeliver:
        events.write.parquet(f"{path}/part={slices + 1}")
    return f"{path}/*"


@register("stream_ledger", LEDGER_SQL)
def q_stream_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Task events streamed one file per micro-batch, the oldest last; each batch writes
    its folded delta.  The fold of the deltas must equal the batch fold (L1)."""
    stream = file_stream(spark, _event_files(spark, d), EVENTS_SCHEMA, max_files_per_trigger=1)
    path = scratch_path(spark, "ledger")
    run_available_now(stream, ledger_handler(path, task_events), scratch_path(spark, "ckpt-led"))
    return ledger.public_ledger(read_ledger(spark, path))


def _broken_bodies(df: DataFrame) -> DataFrame:
    broken = (F.col("event_id") % 10) == 0
    # drop the opening brace: the rest of the body is no longer valid JSON
    return df.select("event_id", F.when(broken, F.col("props").substr(F.lit(2), F.length("props")))
                     .otherwise(F.col("props")).alias("body"))


@register("stream_quarantine", """
WITH b AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN substring(props, 2)
                                 ELSE props END AS body FROM events)
SELECT event_id, body, 'single' AS message_type, 'dlq_single_processing' AS job_name,
       'dlq_processed' AS status
FROM b WHERE NOT json_valid(body)
""")
def q_stream_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Undecodable bodies go to a dead-letter output (V13 rows), each batch in one write."""
    stream = _broken_bodies(file_stream(spark, _event_files(spark, d), EVENTS_SCHEMA,
                                        max_files_per_trigger=1))
    path = scratch_path(spark, "outcomes")
    run_available_now(stream, _quarantine(path), scratch_path(spark, "ckpt-dlq"))
    return read_outcome(spark, path, "dead").select("event_id", "body", "message_type", "job_name",
                                                    "status")


def _quarantine(path: str):
    from pyspark.sql import types as T
    return quarantine_handler(path, "body", T.StructType([T.StructField("k", T.IntegerType())]),
                              lambda df: validate.dead_letter_log(df, "body"))


@register("stream_progress", """
WITH b AS (SELECT CASE WHEN event_id % 10 = 0 THEN substring(props, 2) ELSE props END AS body FROM events)
SELECT 4 AS batches, count(*) AS current, 100.0::DOUBLE AS percentage,
       count(*) FILTER (WHERE json_valid(body)) AS valid,
       count(*) FILTER (WHERE NOT coalesce(json_valid(body), false)) AS dead
FROM b
""")
def q_stream_progress(spark: SparkSession, d: str) -> DataFrame:
    """A9 live, V7 counts: progress of a stream, and the outcomes observed in its writes."""
    from chunkwise.streaming import progress_points
    stream = _broken_bodies(file_stream(spark, _event_files(spark, d), EVENTS_SCHEMA,
                                        max_files_per_trigger=1))
    points = run_available_now(stream, _quarantine(scratch_path(spark, "outcomes")),
                               scratch_path(spark, "ckpt-progress"))
    last = progress_points([{"batch_id": 0, "rows": points[-1]["current"]}],
                           total=table(spark, d, "events").count())[0]
    return spark.createDataFrame(
        [(len(points), last["current"], last["percentage"], sum(p["valid"] for p in points),
          sum(p["dead"] for p in points))],
        "batches int, current long, percentage double, valid long, dead long")


@register("dedupe_batch", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
""")
def q_dedupe_batch(spark: SparkSession, d: str) -> DataFrame:
    """T4 batch twin: every event delivered twice, one copy kept per id."""
    from chunkwise.streaming import dedupe_batch
    ev = table(spark, d, "events")
    return dedupe_batch(ev.unionByName(ev), "event_id")


def _deduped(spark: SparkSession, stream: DataFrame) -> DataFrame:
    sink = scratch_path(spark, "dedup")
    run_available_now(dedupe_stream(stream, "event_id"), batch_sink(sink),
                      scratch_path(spark, "ckpt-dedup"))
    return read_sink(spark, sink).select(*EVENTS_SCHEMA.fieldNames())


@register("dedupe_redelivery", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
""")
def q_dedupe_redelivery(spark: SparkSession, d: str) -> DataFrame:
    """T4: every message delivered twice at once (two sources over the same file)."""
    a = file_stream(spark, f"{d}/events.parq*", EVENTS_SCHEMA)
    b = file_stream(spark, f"{d}/events.parq*", EVENTS_SCHEMA)
    return _deduped(spark, a.unionByName(b))


@register("dedupe_late", "SELECT * FROM events")
def q_dedupe_late(spark: SparkSession, d: str) -> DataFrame:
    """T4: events in several files, the oldest last and then all of them again, a file a
    micro-batch: late rows are kept, copies recognised across batches."""
    return _deduped(spark, file_stream(spark, _event_files(spark, d, redeliver=True),
                                       EVENTS_SCHEMA, max_files_per_trigger=1))


_RESULTS_SQL = """
SELECT 'run-' || (user_id % 7) AS run_id, user_id, count(*) AS item_count,
       sum(round(value * 1000.0)::BIGINT) AS millis
FROM events WHERE user_id IS NOT NULL GROUP BY user_id
"""


@register("stream_combine", f"""
SELECT run_id, 'completed' AS status, count(*) AS total_chunks,
       sum(item_count)::BIGINT AS total_items,
       round(sum(millis)::DOUBLE / 1000.0 / count(*), 2) AS avg_processing_time
FROM ({_RESULTS_SQL}) c WHERE run_id <> 'run-6' GROUP BY run_id
""")
def q_stream_combine(spark: SparkSession, d: str) -> DataFrame:
    """A5 + S7 on a stream: the results of the runs' chunks (a chunk: a user's events) come in
    several files, in no order and all of them twice; each run's job row is emitted once,
    when its last chunk is in.  One run lacks a chunk and has none."""
    from pyspark.sql import Window
    run = Window.partitionBy("run_id")
    results = (table(spark, d, "events").filter("user_id is not null").groupBy("user_id")
               .agg(F.count(F.lit(1)).alias("item_count"),
                    F.sum(F.round(F.col("value") * 1000.0).cast("long")).alias("millis"))
               .withColumn("run_id", F.concat(F.lit("run-"), (F.col("user_id") % 7).cast("string")))
               .withColumn("chunk_id", F.row_number().over(run.orderBy("user_id")) - 1)
               .withColumn("total_chunks", F.count(F.lit(1)).over(run)))
    results = results.filter("run_id <> 'run-6' or chunk_id > 0")
    src = scratch_path(spark, "chunk-results")
    for k in range(3):      # every result in two of the three files
        (results.filter((F.crc32(F.col("user_id").cast("string")) % 3) != k).orderBy(F.desc("user_id"))
         .coalesce(1).write.parquet(f"{src}/part={k}"))
    stream = file_stream(spark, f"{src}/*", results.schema, max_files_per_trigger=1)
    sink = scratch_path(spark, "job-rows")
    run_available_now(combine_runs(stream), batch_sink(sink), scratch_path(spark, "ckpt-combine"),
                      timers=True)
    return read_sink(spark, sink).drop("batch_id")
