"""Forest training, evaluation and scoring with Spark ML.

The scaled numerics are an ``SQLTransformer`` stage, the categories Spark ML's
indexer and one-hot encoder, so features and forest are one ``PipelineModel``:
saved and loaded together and broadcast to executors by Spark.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.config import THRESHOLD, FeatureSpec, ModelParams
from chunkwise.functions import threshold_label
from chunkwise.operators.features import Processor
from chunkwise.operators.metrics import roc_auc
from chunkwise.operators.split import stratified_folds, stratified_split
from chunkwise.session import scratch_path

#: Training and scoring cost far more a row than its few bytes, by which Spark sizes tasks:
#: rows are dealt out by their number.
ROWS_PER_TASK = 10_000


def tasks_for(n_rows: int) -> int:
    return max(1, -(-n_rows // ROWS_PER_TASK))


def processor_sql(proc: Processor) -> str:
    """The scaled numerics of the processor as one SELECT over ``__THIS__``."""
    exprs = []
    for c in proc.num_vars:
        lo, hi = proc.mins.get(c), proc.maxs.get(c)
        if lo is None:
            exprs.append(f"CAST(NULL AS DOUBLE) AS `num_vars__{c}`")
            continue
        rng = (hi - lo) or 1.0
        exprs.append(f"(CAST(`{c}` AS DOUBLE) - CAST({lo!r} AS DOUBLE)) / "
                     f"CAST({rng!r} AS DOUBLE) AS `num_vars__{c}`")
    return "SELECT *" + "".join(f", {e}" for e in exprs) + " FROM __THIS__"


def fit_encoder(proc: Processor, scope: DataFrame) -> PipelineModel:
    """Scaler and category encoder, fitted once on ``scope``: ``StringIndexer``
    (alphabetical, unseen and null in a bucket of their own, the last) and
    ``OneHotEncoder`` whose ``dropLast`` drops that bucket, so they become all zeros.
    Sparse vectors, for any number of categories."""
    stages, cats = [SQLTransformer(statement=processor_sql(proc))], list(proc.cat_vars)
    features = [f"num_vars__{c}" for c in proc.num_vars]
    if cats:
        index, vectors = [f"_idx_{c}" for c in cats], [f"_vec_{c}" for c in cats]
        stages += [StringIndexer(inputCols=cats, outputCols=index, handleInvalid="keep",
                                 stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCols=index, outputCols=vectors, dropLast=True)]
        features += vectors
    stages.append(VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages).fit(scope)


def build_pipeline(encoder: PipelineModel, params: ModelParams, label: str) -> Pipeline:
    """The fitted encoder's stages and a forest: one model to save, load and broadcast."""
    return Pipeline(stages=[
        *encoder.stages,
        RandomForestClassifier(featuresCol="features", labelCol=label,
                               numTrees=params.n_estimators, maxDepth=params.max_depth,
                               maxBins=params.max_bins, seed=params.seed,
                               maxMemoryInMB=params.max_memory_mb,
                               cacheNodeIds=True),     # deep trees: no re-walk per level
    ])


@dataclass
class TrainResult:
    model: PipelineModel
    processor: Processor
    fold_metrics: list[dict] = field(default_factory=list)
    split: DataFrame | None = None      # the training rows with their ``split``

    @property
    def mean_auc_seen(self) -> float | None:
        v = [m["val_auc"] for m in self.fold_metrics if m.get("val_auc") is not None]
        return sum(v) / len(v) if v else None

    @property
    def mean_auc_unseen(self) -> float | None:
        v = [m["test_auc"] for m in self.fold_metrics if m.get("test_auc") is not None]
        return sum(v) / len(v) if v else None


def train_forest(clean: DataFrame, spec: FeatureSpec, params: ModelParams = ModelParams(),
                 fit_scope: str = "all", refit: str = "last_fold") -> TrainResult:
    """F10 + F11 + F16: stratified hold-out, stratified k-fold; per fold a
    forest is fit, validation and hold-out AUC are computed; the last fold's
    model is returned (``refit="all"`` refits on the whole train split).
    A fold that fails is reported and skipped; if all fail, so does the training.  Scaler and categories are fitted once,
    on all rows or (``fit_scope="train"``) on the train split.

    The cleaned rows are written once to the shared folder and dealt over tasks
    of ``ROWS_PER_TASK`` rows.  Folds are fitted concurrently (Spark runs the jobs
    of several driver threads at once) and all fold AUCs come from one grouped
    exact-AUC pass over the scored rows, which are written first: the ranges of
    that pass are sampled, so it reads its input twice.
    """
    from concurrent.futures import ThreadPoolExecutor

    label, id_col = spec.target, spec.id_col
    path = scratch_path(clean.sparkSession, "train-rows")
    clean.withColumn(label, F.col(label).cast("double")).write.parquet(path)
    data = clean.sparkSession.read.parquet(path)
    tasks = tasks_for(data.count())
    split = stratified_split(data, label, id_col, params.test_size, params.seed,
                             num_partitions=tasks)
    train = split.filter(F.col("split") == "train").drop("split")
    test = split.filter(F.col("split") == "test").drop("split")
    scope = data if fit_scope == "all" else train
    proc = Processor.fit(scope, spec)
    est = build_pipeline(fit_encoder(proc, scope), params, label)
    folds = stratified_folds(train, label, id_col, params.n_splits, params.seed,
                             num_partitions=tasks)

    def fit(rows: DataFrame) -> PipelineModel:
        # without the training summary, which holds the session and can't go to tasks with it
        return est.fit(rows).copy()

    def fit_fold(k: int):
        try:
            return k, fit(folds.filter(F.col("fold") != k)), None
        except Exception as err:  # noqa: BLE001 - reported, fold skipped
            return k, None, str(err)

    with ThreadPoolExecutor(max_workers=max(1, min(params.parallelism, params.n_splits))) as ex:
        fitted = list(ex.map(fit_fold, range(params.n_splits)))

    if all(m is None for _, m, _ in fitted):
        raise RuntimeError("no fold could be fitted: " + "; ".join(err for _, _, err in fitted))
    evals = []
    for k, model, _ in fitted:
        if model is None:
            continue
        for name, part in (("val", folds.filter(F.col("fold") == k).drop("fold")), ("test", test)):
            evals.append(score_batch(model, part).select(
                id_col, label, "probability", F.lit(f"{name}:{k}").alias("_eval")))
    aucs: dict[str, float | None] = {}
    if evals:
        union = evals[0]
        for e in evals[1:]:
            union = union.unionByName(e)
        path = scratch_path(clean.sparkSession, "fold-scores")
        union.write.parquet(path)
        union = clean.sparkSession.read.schema(union.schema).parquet(path)
        aucs = {r["_eval"]: r["auc"] for r in
                roc_auc(union, "probability", label, id_col, group="_eval").collect()}
    metrics, model = [], None
    for k, fold_model, err in fitted:
        if fold_model is None:
            metrics.append({"fold": k, "error": err})
            continue
        metrics.append({"fold": k, "val_auc": aucs.get(f"val:{k}"),
                        "test_auc": aucs.get(f"test:{k}")})
        model = fold_model
    if refit == "all":
        model = fit(train)
    return TrainResult(model, proc, metrics, split)


def score_batch(model: PipelineModel, df: DataFrame, threshold: float = THRESHOLD,
                label_col: str = "survived") -> DataFrame:
    """F12 + F13: input columns + ``probability`` (class 1, unrounded) and
    the thresholded label (``p > threshold``, overwriting any given label)."""
    out = model.transform(df)
    prob = vector_to_array(F.col("probability")).getItem(1)
    keep = [c for c in df.columns if c != label_col]
    return out.select(*keep, prob.alias("probability"),
                      threshold_label(prob, threshold).cast("int").alias(label_col))


def score_one(model: PipelineModel, df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """single-record scoring is batch scoring of a one-row frame."""
    return score_batch(model, df.limit(1), threshold)


_MODEL_CACHE: dict[str, PipelineModel] = {}


def save_model(model: PipelineModel, path: str) -> str:
    """processor and forest saved together."""
    model.write().overwrite().save(path)
    _MODEL_CACHE.pop(path, None)
    return path


def load_model(path: str, use_cache: bool = True) -> PipelineModel:
    """loaded once per driver process; ``clear_model_cache`` resets."""
    if use_cache and path in _MODEL_CACHE:
        return _MODEL_CACHE[path]
    model = PipelineModel.load(path)
    _MODEL_CACHE[path] = model
    return model


def clear_model_cache() -> None:
    _MODEL_CACHE.clear()
