"""Streaming restarts, model training/scoring plumbing, entry contract."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwise.config import FeatureSpec, ModelParams
from chunkwise.operators.features import clean_training_frame
from chunkwise.operators.model import load_model, save_model, score_batch, train_forest
from chunkwise.plans.catalog import EVENTS_SCHEMA
from chunkwise.plans.learned import MODEL_SPEC, _labelled
from chunkwise.session import scratch_path
from chunkwise.streaming import (batch_sink, combine_runs, dedupe_stream, file_stream,
                                 progress_points, read_outcome, read_sink, run_available_now)

from conftest import SF_SMALL


def test_dedupe_restart_adds_nothing(spark):
    src = f"{SF_SMALL}/events.parq*"
    sink, ckpt = scratch_path(spark, "dd"), scratch_path(spark, "dd-ckpt")

    def run():
        a = file_stream(spark, src, EVENTS_SCHEMA)
        b = file_stream(spark, src, EVENTS_SCHEMA)
        run_available_now(dedupe_stream(a.unionByName(b), "event_id"), batch_sink(sink), ckpt)
        return read_sink(spark, sink).count()

    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert run() == n
    assert run() == n            # restart from the checkpoint: no new rows


def test_dedupe_keeps_late_rows(spark):
    """One-row batches, one of them months older, then copies, in two runs of one checkpoint."""
    src, sink, ckpt = (scratch_path(spark, n) for n in ("late-src", "late", "late-ckpt"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.StringType())])
    rows = [(1, "2024-06-01"), (2, "2024-06-02"), (3, "2024-01-01"), (1, "2024-06-01"), (None, "x")]
    for part in (rows, [rows[2], rows[4], (4, "2023-01-01")]):
        for row in part:
            spark.createDataFrame([row], schema).write.mode("append").parquet(src)
        stream = file_stream(spark, src, schema, max_files_per_trigger=1)
        points = run_available_now(dedupe_stream(stream, "id"), batch_sink(sink), ckpt)
        assert points[-1]["current"] == len(part)       # input rows, copies too
    got = sorted((r.id or 0, r.ts) for r in read_sink(spark, sink).collect())
    assert got == [(0, "x"), (1, "2024-06-01"), (2, "2024-06-02"), (3, "2024-01-01"), (4, "2023-01-01")]


def test_dedupe_reads_its_batch_only(spark):
    """The plan of a late micro-batch holds the batch's own file and the state, no sink; what
    a batch reads doesn't grow with the batches before it."""
    src, sink = scratch_path(spark, "plan-src"), scratch_path(spark, "plan")
    for k in range(6):
        spark.range(100 * k, 100 * k + 150).coalesce(1).write.parquet(f"{src}/part={k}")
    stream = file_stream(spark, f"{src}/*", spark.range(1).schema, max_files_per_trigger=1)
    from chunkwise.streaming import rocksdb_state
    with rocksdb_state(spark):
        q = dedupe_stream(stream, "id").writeStream.foreachBatch(batch_sink(sink)).option(
            "checkpointLocation", scratch_path(spark, "plan-ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    plan = q._jsq.explainInternal(False)
    assert "StreamingDeduplicate" in plan and plan.count("Scan") == 1 and sink not in plan
    rows = [p.numInputRows for p in q.recentProgress if p.numInputRows]
    assert rows == [150] * 6
    state = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.numInputRows]
    assert state[-1] == 650
    assert any("rocksdb" in k for k in q.lastProgress.stateOperators[0].customMetrics)
    assert read_sink(spark, sink).count() == 650


def _chunk_rows(run, total, chunks):
    return [(run, c, total, 10 + c, 1000 * c + 500) for c in chunks]


_CHUNKS = "run_id string, chunk_id long, total_chunks long, item_count long, millis long"


def test_a_run_is_combined_when_its_last_chunk_is_in(spark):
    """Runs' chunks over several batches, in any order, again and again; one run lacks one;
    rows that are no results; late copies in a second run of the stream."""
    src, sink, ckpt = (scratch_path(spark, n) for n in ("cr-src", "cr", "cr-ckpt"))
    batches = [
        _chunk_rows("a", 3, [2, 0, 0]) + _chunk_rows("one", 1, [0]) + _chunk_rows("b", 20, range(0, 20, 2)),
        _chunk_rows("a", 3, [2]) + _chunk_rows("b", 20, [1, 3, 19]) + [(None, 0, 1, 1, 1), ("c", None, 1, 1, 1)],
        _chunk_rows("a", 3, [1, 1]) + _chunk_rows("b", 20, range(20)) + _chunk_rows("never", 4, [0, 1, 3, 7, -1]),
        _chunk_rows("a", 3, [0, 1, 2]) + _chunk_rows("one", 1, [0, 0]),
    ]
    done = {}
    for batch in batches:       # each its own run of the stream: state comes from the checkpoint
        spark.createDataFrame(batch, _CHUNKS).coalesce(1).write.mode("append").parquet(src)
        stream = file_stream(spark, src, spark.createDataFrame([], _CHUNKS).schema)
        run_available_now(combine_runs(stream), batch_sink(sink), ckpt, timers=True)
        done[len(done)] = sorted(r.run_id for r in read_sink(spark, sink).collect())
    assert done == {0: ["one"], 1: ["one"], 2: ["a", "b", "one"], 3: ["a", "b", "one"]}
    got = {r.run_id: r for r in read_sink(spark, sink).collect()}
    for run, total in (("a", 3), ("b", 20), ("one", 1)):
        r = got[run]
        assert (r.status, r.total_chunks, r.total_items) == ("completed", total, sum(10 + c for c in range(total)))
        assert r.avg_processing_time == round(sum(c + 0.5 for c in range(total)) / total, 2)


def test_a_run_that_is_overdue_is_told_once():
    """The processor by itself, with a clock and a state of our own."""
    import pandas as pd
    from chunkwise.streaming.state import CombineRuns

    class Value:
        held = None
        def exists(self): return self.held is not None                  # noqa: E704
        def get(self): return self.held                                 # noqa: E704
        def update(self, v): self.held = v                              # noqa: E704
        def clear(self): self.held = None                               # noqa: E704

    class Handle:
        def __init__(self): self.value, self.timers = Value(), []       # noqa: E704
        def getValueState(self, name, schema): return self.value        # noqa: E704
        def registerTimer(self, at): self.timers.append(at)             # noqa: E704
        def listTimers(self): return iter(self.timers)                  # noqa: E704

    class Clock:
        def __init__(self, now): self.now = now                         # noqa: E704
        def getCurrentProcessingTimeInMs(self): return self.now         # noqa: E704
        getExpiryTimeInMs = getCurrentProcessingTimeInMs

    handle, run = Handle(), CombineRuns(overdue_ms=1000, forget_ms=5000)
    run.init(handle)
    rows = lambda chunks: iter([pd.DataFrame(_chunk_rows("r", 3, chunks), columns=[     # noqa: E731
        c.split()[0] for c in _CHUNKS.split(", ")])])

    def expire(at):
        handle.timers.remove(at)
        return [r.to_dict("records")[0] for r in run.handleExpiredTimer(("r",), Clock(at), Clock(at))]

    assert list(run.handleInputRows(("r",), rows([0, 2]), Clock(0))) == [] and handle.timers == [1000]
    [late] = expire(1000)
    assert (late["status"], late["total_chunks"], late["total_items"]) == ("overdue", 2, 22)
    [whole] = run.handleInputRows(("r",), rows([2, 1, 0]), Clock(2000))
    assert whole.to_dict("records")[0]["status"] == "completed" and handle.timers == [7000]
    assert list(run.handleInputRows(("r",), rows([1]), Clock(3000))) == []
    assert expire(7000) == [] and handle.value.held is None


def test_train_and_score_small_forest(spark):
    clean = clean_training_frame(_labelled(spark, SF_SMALL), MODEL_SPEC, fill_col=None)
    params = ModelParams(n_estimators=5, max_depth=3)
    res = train_forest(clean, MODEL_SPEC, params)
    assert len(res.fold_metrics) == 5
    assert all("error" not in m for m in res.fold_metrics)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"), "lang", "source")
    scored = score_batch(res.model, docs)
    assert scored.count() == docs.count()
    bad = scored.filter((F.col("probability") < 0) | (F.col("probability") > 1)
                        | ((F.col("probability") > 0.5) != (F.col("survived") == 1)))
    assert bad.count() == 0
    path = save_model(res.model, scratch_path(spark, "m"))
    again = score_batch(load_model(path, use_cache=False), docs)
    a = {r.doc_id: r.probability for r in scored.collect()}
    b = {r.doc_id: r.probability for r in again.collect()}
    assert a == b


def test_training_and_stream_scoring_spread_over_tasks_by_rows(spark, monkeypatch, tmp_path):
    from chunkwise.operators import model as m
    from chunkwise.plans import learned
    monkeypatch.setattr(m, "ROWS_PER_TASK", 20)
    docs = spark.range(200).select(
        F.col("id").alias("doc_id"), (F.col("id") * 7 % 90).alias("n_chars"),
        F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    docs.select("doc_id", F.lit(1).alias("quality")).coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    fitted, scored = [], []
    folds, score = m.stratified_folds, learned.score_batch

    def fold(*args, **kwargs):
        fitted.append(folds(*args, **kwargs))
        return fitted[-1]

    def note(model, df):
        scored.append(df.rdd.getNumPartitions())
        return score(model, df)

    monkeypatch.setattr(m, "stratified_folds", fold)
    monkeypatch.setattr(learned, "score_batch", note)
    small = ModelParams(n_estimators=5, max_depth=3, n_splits=2)
    train = learned.trained
    monkeypatch.setattr(learned, "trained", lambda s, d: train(s, d, small))
    out = learned.q_stream_score(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(200)) and all(r["same_as_batch"] for r in out)
    assert [f.rdd.getNumPartitions() for f in fitted] == [10]
    assert sum(scored[:-1]) >= 10  # the micro-batches; the last one is the batch twin


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].total_items > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_batch_predict_end_to_end(spark):
    """E1 + E3 on the person contract: train on labelled persons, then
    validate -> score -> prediction rows for a JSON batch with one bad row."""
    import json
    from chunkwise.config import FeatureSpec
    from chunkwise.operators import validate
    from chunkwise.plans.jobs import batch_predict, train
    from chunkwise.schemas import DATA_ENVELOPE_KEYS
    from conftest import PERSONS
    people = []
    for i in range(40):
        p = dict(PERSONS[i % 5])
        p["personId"] = f"p{i}"
        p["age"] = None if i % 7 == 0 else p["age"] + i      # null age -> filled
        p["sex"] = p["sex"].upper()                          # lower-cased in cleaning
        p["survived"] = i % 2
        people.append(p)
    raw = spark.createDataFrame(people).withColumnRenamed("personId", "person_id")
    res = train(raw, FeatureSpec(), ModelParams(n_estimators=3, max_depth=2, n_splits=2))
    assert len(res.fold_metrics) == 2
    batch = PERSONS + [{**PERSONS[0], "embarked": "zz"}]
    body = spark.createDataFrame([(json.dumps({"data": batch}),)], "body string")
    items = validate.explode_envelope(body, "body", DATA_ENVELOPE_KEYS, "data")
    persons, preds, rejected = batch_predict(res.model, items, map_col="item")
    assert persons.count() == 5 and rejected.count() == 1
    rows = preds.collect()
    assert len(rows) == 5 and all(r.status == "success" for r in rows)
    assert {r.data.person_id for r in rows} == {p["personId"] for p in PERSONS}
    assert all(r.data.survived == (1 if r.data.probability > 0.5 else 0) or
               abs(r.data.probability - 0.5) < 0.006 for r in rows)


def test_encoder_matches_dense_features(spark):
    """The encoder's vectors are the dense processor's columns (unseen and null: zeros)."""
    from pyspark.ml.functions import vector_to_array
    from chunkwise.operators.features import Processor
    from chunkwise.operators.model import fit_encoder
    clean = clean_training_frame(_labelled(spark, SF_SMALL), MODEL_SPEC, fill_col=None)
    dense = Processor.fit(clean, MODEL_SPEC, with_categories=True)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        F.when(F.col("doc_id") % 7 != 0, F.col("lang")).alias("lang"),
        F.when(F.col("doc_id") % 5 == 0, F.lit("unseen")).otherwise(F.col("source")).alias("source"))
    a = {r[0]: [float(x) for x in r[1:]] for r in dense.transform(docs, ["doc_id"]).collect()}
    b = {r.doc_id: r.p for r in fit_encoder(Processor.fit(clean, MODEL_SPEC), clean).transform(docs)
         .select("doc_id", vector_to_array("features").alias("p")).collect()}
    assert a == b


def test_encoder_is_fitted_once_on_its_scope(spark):
    """Categories of the hold-out are known with fit_scope="all" and unseen with "train"."""
    rows = [(i, float(i % 7), "rare%d" % i, i % 2) for i in range(60)]
    clean = spark.createDataFrame(rows, "doc_id long, n_chars double, source string, quality int")
    spec = FeatureSpec(num_vars=("n_chars",), cat_vars=("source",), target="quality", id_col="doc_id")
    known = {}
    for scope in ("all", "train"):
        res = train_forest(clean, spec, ModelParams(n_estimators=2, max_depth=2, n_splits=2),
                           fit_scope=scope)
        known[scope] = {len(s.labelsArray[0]) for s in res.model.stages if hasattr(s, "labelsArray")}
    assert known == {"all": {60}, "train": {48}}


def test_saving_over_a_loaded_model_is_seen(spark):
    clean = clean_training_frame(_labelled(spark, SF_SMALL), MODEL_SPEC, fill_col=None)
    models = [train_forest(clean, MODEL_SPEC, ModelParams(n_estimators=n, max_depth=2, n_splits=2)).model
              for n in (1, 3)]
    path = save_model(models[0], scratch_path(spark, "over"))
    assert load_model(path).stages[-1].getNumTrees == 1
    save_model(models[1], path)
    assert load_model(path).stages[-1].getNumTrees == 3


def test_foreach_batch_handlers_are_replay_safe(spark):
    """Running a handler twice for the same batch id (a replay after a crash
    between writes) leaves exactly one copy of each output."""
    from pyspark.sql import types as T
    from chunkwise.operators import validate
    from chunkwise.streaming import quarantine_handler
    batch = spark.createDataFrame([(1, '{"k": 1}'), (2, '"k": 2}'), (3, None)],
                                  "event_id long, body string")
    path = scratch_path(spark, "outcomes")
    handle = quarantine_handler(path, "body", T.StructType([T.StructField("k", T.IntegerType())]),
                                lambda df: validate.dead_letter_log(df, "body"))
    assert handle(batch, 0) == {"rows": 3, "valid": 1, "dead": 2}
    handle(batch, 0)
    ok = read_outcome(spark, path, "valid").collect()
    assert [(r.event_id, r.payload.k, r.job_name) for r in ok] == [(1, 1, None)]
    dl = read_outcome(spark, path, "dead")
    assert sorted(r.event_id for r in dl.collect()) == [2, 3]
    assert {r.job_name for r in dl.collect()} == {"dlq_single_processing"}
    sink = scratch_path(spark, "sink")
    write = batch_sink(sink)
    write(batch, 5)
    write(batch, 5)
    assert spark.read.parquet(sink).count() == 3


def test_stream_progress_is_complete(spark):
    """More micro-batches than Spark keeps in its own list of recent progress."""
    src, sink = scratch_path(spark, "pp-src"), scratch_path(spark, "pp")
    n, files = 60, 12
    spark.range(n).repartition(files).write.parquet(src)
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        stream = file_stream(spark, src, spark.range(1).schema, max_files_per_trigger=1)
        pts = run_available_now(stream, batch_sink(sink), scratch_path(spark, "pp-ckpt"))
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    assert len(pts) == files and pts[-1]["current"] == n
    assert progress_points([{"batch_id": 0, "rows": 5}], total=10)[0]["percentage"] == 50.0


def test_progress_counts_every_row_once(spark):
    """Each handler's progress ends at the number of input rows, whatever it does with them."""
    from chunkwise.plans.tables import task_events
    from chunkwise.plans.learned import _quarantine
    from chunkwise.sources.counted import counting
    from chunkwise.streaming import ledger_handler
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()

    def twice(batch, batch_id):         # a handler that evaluates its batch again
        counted, counts = counting(batch, rows=F.lit(True))
        counted.write.mode("overwrite").parquet(f"{scratch_path(spark, 'twice')}/batch_id={batch_id}")
        batch.count()
        return counts()

    for make in (batch_sink, lambda p: ledger_handler(p, task_events), _quarantine, lambda p: twice):
        stream = file_stream(spark, f"{SF_SMALL}/events.parq*", EVENTS_SCHEMA).withColumn("body", F.col("props"))
        points = run_available_now(stream, make(scratch_path(spark, "p")), scratch_path(spark, "p-ckpt"))
        assert points[-1]["current"] == n


def test_a_fitted_forest_goes_to_tasks_after_observed_writes(spark):
    """A model's training summary holds the session, which an observation makes impossible to
    send; and if no fold can be fitted, training says so."""
    from chunkwise.sources.counted import counting
    import pytest
    df, counts = counting(spark.range(3), n=F.lit(True))
    df.count()
    assert counts() == {"n": 3}
    rows = [(i, float(i % 7), "ab"[i % 2], i % 2) for i in range(60)]
    clean = spark.createDataFrame(rows, "doc_id long, n_chars double, source string, quality int")
    spec = FeatureSpec(num_vars=("n_chars",), cat_vars=("source",), target="quality", id_col="doc_id")
    res = train_forest(clean, spec, ModelParams(n_estimators=2, max_depth=2, n_splits=2))
    assert score_batch(res.model, clean).rdd.count() == 60
    with pytest.raises(RuntimeError, match="no fold"):
        train_forest(clean, spec, ModelParams(n_estimators=2, max_depth=2, n_splits=2, max_bins=1))
