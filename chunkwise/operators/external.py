"""Scoring with a model that is not Spark's.

A user's fitted model, any picklable object with ``predict_proba(matrix)`` or
``predict(matrix)``, goes to the executors as one broadcast, is unpickled once in each Python
process (not once a batch or a task) and scores Arrow batches of bounded size, column by
column into one matrix.  The rows stay in their partitions: no shuffle.
"""

from __future__ import annotations

import pickle
from collections import OrderedDict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwise.config import THRESHOLD
from chunkwise.functions import threshold_label
from chunkwise.session import ship_package

#: A larger model is refused: every executor holds its bytes, every Python process the model.
MOST_BYTES = 1 << 30
#: Models that a process keeps; scoring with more of them in turn unpickles again.
KEPT_MODELS = 4

_models: OrderedDict = OrderedDict()


@dataclass(frozen=True)
class ExternalModel:
    """A model on its way to the executors: its bytes, and the features in their order."""

    content: Broadcast
    key: str
    features: tuple[str, ...]


def external_model(spark: SparkSession, model, features: Sequence[str]) -> ExternalModel:
    """Broadcast ``model`` (the object itself, or its pickled bytes, for example of a file
    that ``spark.read.format("binaryFile")`` has read)."""
    import hashlib
    content = model if isinstance(model, bytes) else pickle.dumps(model)
    if len(content) > MOST_BYTES:
        raise ValueError(f"the model has {len(content)} bytes, more than {MOST_BYTES}")
    ship_package(spark)
    return ExternalModel(spark.sparkContext.broadcast(content),
                         hashlib.sha256(content).hexdigest(), tuple(features))


def loaded(model: ExternalModel):
    """The model in this process, unpickled when it is first asked for."""
    if model.key in _models:
        _models.move_to_end(model.key)
    else:
        _models[model.key] = pickle.loads(model.content.value)
        while len(_models) > KEPT_MODELS:
            _models.popitem(last=False)
    return _models[model.key]


def _probability(model, matrix: np.ndarray) -> np.ndarray:
    """Of class 1: the last column of ``predict_proba``, else what ``predict`` gives."""
    if hasattr(model, "predict_proba"):
        return np.asarray(model.predict_proba(matrix), float)[:, -1]
    return np.asarray(model.predict(matrix), float).reshape(len(matrix))


def score_external(model: ExternalModel, df: DataFrame, threshold: float = THRESHOLD,
                   label_col: str = "survived") -> DataFrame:
    """``df`` with ``probability`` (unrounded) and the thresholded label, as ``score_batch``.
    A row with a null feature has a null probability and label: no model is asked about it.
    A feature that is missing fails before anything runs."""
    keep = [c for c in df.columns if c not in (label_col, "probability")]
    features = list(model.features)
    cols = [F.col(f"`{c}`") for c in keep]
    inputs = [F.col(f"`{f}`").cast("double").alias(f"_x{k}") for k, f in enumerate(features)]
    rows = df.select(*cols, *inputs)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields[:len(keep)]]
                          + [T.StructField("probability", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            given = [batch.column(len(keep) + k) for k in range(len(features))]
            known = np.ones(n, bool)
            for x in given:
                known &= ~x.is_null().to_numpy(zero_copy_only=False)
            scores, at = np.full(n, np.nan), np.flatnonzero(known)
            if len(at):
                matrix = np.column_stack([x.to_numpy(zero_copy_only=False)[at] for x in given])
                scores[at] = _probability(loaded(model), matrix)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(scores, pa.float64(), mask=~known)],
                [*keep, "probability"])

    out = rows.mapInArrow(run, schema)
    p = F.col("probability")
    return out.withColumn(label_col, F.when(p.isNotNull(), threshold_label(p, threshold)).cast("int"))
