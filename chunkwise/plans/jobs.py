"""End-to-end jobs composed from the operators.

* ``chunk_job``      E2 summary: validate -> chunk -> per-chunk stats -> job roll-up
* ``run_chunk_job``  E2 written out: chunk outputs, chunk stats, job-log row, events
* ``batch_predict``  E1: validate -> score -> prediction rows (+ rejected);
  ``predict_run`` writes them under a run id
* ``train``          E3: clean -> fit processor -> split -> folds -> forest
* ``periodic``       E4: retention sweep (survivors to new paths, counts) + health counts
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.config import API_CHUNK_SIZE, FeatureSpec, ModelParams
from chunkwise.functions import norm_category, one_of
from chunkwise.operators import chunks, validate
from chunkwise.operators.features import clean_training_frame
from chunkwise.operators.model import TrainResult, score_batch, train_forest
from chunkwise.sources import scan_project
from chunkwise.sources.counted import counting


def chunk_job(spark: SparkSession, orders_path: str, size: int = API_CHUNK_SIZE,
              mode: str = "quarantine") -> DataFrame:
    """E2 on orders: the order status is the validated category, the order
    total (whole units) stands in for a measured per-item duration.

    ``quarantine`` / ``fail_job``: records are validated first and the valid
    ones chunked (the API path).  ``fail_chunk``: the input is chunked first
    and a bad record drops its whole chunk (the per-chunk task path)."""
    o = scan_project(spark, orders_path, ["o_orderkey", "o_orderstatus", "o_totalprice"])
    o = o.withColumn("duration", F.round("o_totalprice").cast("long"))
    rules = [one_of("o_orderstatus", ("o", "f"), norm_category("o_orderstatus"))]
    if mode == "fail_chunk":
        # several consumers (valid rows, bad chunk ids): checkpointed layout
        chunked = chunks.assign_chunks(o.select("o_orderkey", "o_orderstatus", "duration"),
                                       ["o_orderkey"], size)
        valid, _rejected = validate.split_valid(validate.with_errors(chunked, rules), mode)
        return chunks.combine_chunks(chunks.chunk_stats(valid, "duration"))
    valid, _rejected = validate.split_valid(validate.with_errors(o, rules), mode)
    chunked = chunks.assign_chunks(valid.select("o_orderkey", "duration"), ["o_orderkey"], size)
    return chunks.combine_chunks(chunks.chunk_stats(chunked, "duration"))


def run_chunk_job(df: DataFrame, order_by: list[str], out_root: str, run_id: str,
                  job_name: str = "bulk_data_processing", size: int = API_CHUNK_SIZE,
                  duration: str | None = None, map_step=None, sample_col: str | None = None,
                  completed_at: Column | None = None, model_name: str = "none") -> dict:
    """E2 written out: chunk the input, apply ``map_step`` (default: upper-case
    strings), write the chunk outputs, the per-chunk stats, one job-log row and the
    completed events (one a chunk, one for the run).  Everything lies under the run's id
    (``<root>/<kind>/run_id=<id>``), so a repeated run replaces its own rows and runs never
    mix.  Returns the paths and the combined summary (one small row)."""
    from chunkwise.functions import upper_strings
    from chunkwise.sources import build_events, completed_event, publish_events, row_id
    step = map_step or upper_strings
    out = step(chunks.assign_chunks(df, order_by, size))
    spark, root = out.sparkSession, out_root.rstrip("/")
    paths = {k: f"{root}/{k}" for k in ("output", "chunks", "jobs", "events")}
    own = {k: f"{p}/run_id={run_id}" for k, p in paths.items()}
    out.write.mode("overwrite").parquet(own["output"])
    written = spark.read.parquet(own["output"])     # cut lineage: reuse the write
    stats = chunks.chunk_stats(written, duration)
    stats.write.mode("overwrite").parquet(own["chunks"])
    stats = spark.read.parquet(own["chunks"])
    column = sample_col or order_by[0]
    sample = chunks.sample_head(written.select("chunk_id", "item_index", column))
    done = completed_at if completed_at is not None else F.current_timestamp()
    job = chunks.job_log(stats, sample, job_name, column, done)
    keyed = job.withColumn("_run", F.lit(run_id)).withColumn("row_id", row_id(["_run"])).drop("_run")
    keyed.withColumn("created_at", done).write.mode("overwrite").parquet(own["jobs"])
    each = build_events(stats, {"status": F.lit("success"), "chunk_id": F.col("chunk_id"),
                                "item_count": F.col("item_count")}, queue="chunks", run_id=run_id)
    whole = completed_event(chunks.combine_chunks(stats), sample, column, run_id=run_id,
                            task_id=f"{job_name}:{run_id}", model_name=model_name,
                            data_path=own["output"], completed_at=done, queue="results")
    publish_events(each.unionByName(whole), own["events"], mode="overwrite")
    summary = chunks.combine_chunks(stats).first().asDict()
    return {"paths": paths, **summary}


def predict_run(model, raw: DataFrame, out_root: str, run_id: str, now: Column | None = None,
                map_col: str | None = None) -> dict[str, str]:
    """E1 written out: raw person records are validated and scored; persons, prediction
    rows and rejects go to ``<root>/<kind>/run_id=<id>``.  A repeated run replaces its own
    rows.  The validated persons are written once and scored from there."""
    root = out_root.rstrip("/")
    paths = {k: f"{root}/{k}" for k in ("checked", "predictions")}
    own = {k: f"{p}/run_id={run_id}" for k, p in paths.items()}
    split = validate.write_split(validate.validate_persons(raw, now, map_col=map_col), own["checked"])
    spark = raw.sparkSession
    persons = spark.read.parquet(own["checked"]).filter("outcome = 'valid'").drop(
        validate.ERRORS, "outcome")
    validate.prediction_struct(score_batch(model, persons), now).write.mode("overwrite").parquet(
        own["predictions"])
    return {"persons": split["valid"], "rejected": split["rejected"],
            "checked": own["checked"], "predictions": own["predictions"]}


def sweep_table(spark: SparkSession, path: str, out: str, ts_col: str, cutoff: Column) -> int:
    """The survivors of the table at ``path`` written to ``out``; the number of rows that
    went, observed in that write."""
    from chunkwise.operators import ledger
    from chunkwise.sources import rewrite_table
    told = {}

    def sweep(df: DataFrame) -> DataFrame:
        counted, told["counts"] = counting(df, deleted=F.col(ts_col) < cutoff)
        return ledger.retained(counted, ts_col, cutoff)

    rewrite_table(spark, path, out, sweep)
    return told["counts"]()["deleted"]


def periodic(tables: dict, as_of: Column, out_root: str, health: dict | None = None) -> dict:
    """The retention sweep writes each table's survivors to ``<root>/<name>`` (a new
    path) and reports deleted counts; optionally the health counts.  ``tables`` maps a name
    to ``(path, ts_col)``; ``health`` holds the ``ledger.health_stats`` arguments except
    ``as_of``.  Each table is read once: its counts are observed in the write."""
    from chunkwise.operators import ledger
    cutoff, result = ledger.retention_cutoff(as_of), {"cleaned_up": {}}
    spark = SparkSession.active()
    for name, (path, ts_col) in tables.items():
        result["cleaned_up"][name] = sweep_table(spark, path, f"{out_root.rstrip('/')}/{name}",
                                                 ts_col, cutoff)
    if health:
        result["stats"] = ledger.health_stats(as_of=as_of, **health).first().asDict()
    return result


def batch_predict(model, persons_raw: DataFrame, now: Column | None = None,
                  mode: str = "quarantine", map_col: str | None = None
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw person records (columns, or JSON objects as maps in
    ``map_col``) -> (valid persons, prediction rows, rejected rows)."""
    checked = validate.validate_persons(persons_raw, now, map_col=map_col)
    valid, rejected = validate.split_valid(checked, mode)
    persons = valid.drop(validate.ERRORS)
    scored = score_batch(model, persons)
    return persons, validate.prediction_struct(scored, now), rejected


def train(raw: DataFrame, spec: FeatureSpec, params: ModelParams = ModelParams(),
          fill_col: str | None = "age", fit_scope: str = "all",
          refit: str = "last_fold") -> TrainResult:
    """Clean (lower, fill, drop nulls) then the forest with validation."""
    clean = clean_training_frame(raw, spec, fill_col=fill_col)
    return train_forest(clean, spec, params, fit_scope=fit_scope, refit=refit)
