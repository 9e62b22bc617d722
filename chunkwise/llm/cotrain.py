"""Quality classifier by co-training (operator 7).

Two views of a document that can each tell quality alone: its text (shares of character
kinds, word and line statistics, repetition) and its metadata (source, language, length as
recorded).  Each round fits a logistic regression on each view and hands the unlabelled
documents of which one view is confident, with that label, to the other.  After the last
round both views are calibrated on labelled documents that no fit has seen, and combined as
independent evidence.  All labelled and unlabelled documents take part; the fits are Spark
ML's, over a narrow feature table that is written once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField, StructType

from .common import BLANKS, slices, stored, utf8, word_hashes
from .toxicity import fold

ROUNDS = 3
#: A view labels a document for the other view from this probability on, either way.
CONFIDENT = 0.97
PSEUDO_WEIGHT = 0.5
SOURCE_SLOTS, LANG_SLOTS = 32, 8

#: Kinds of bytes whose shares are features.
_KINDS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n",
          b"\t", b".", b",", b"!", b"?", b"#", b"$", b"%", b"&", b"*", b"|", b"<>", b"{}[]()",
          b"=+", b"@", b"/\\", b":;", b"-_", b"'\"`", b"~^"]
_KIND = np.full(256, len(_KINDS) + 1)
for _k, _chars in enumerate(_KINDS):
    _KIND[list(_chars)] = _k
_KIND[128:] = len(_KINDS)
_N_KINDS = len(_KINDS) + 2
_LINES = np.arange(256) == 10
#: Bytes of text handled at once: arrays of some sixty bytes for each are live.
_SLICE = 1 << 18


def _distinct_share(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Distinct items of each row per item (1 without items)."""
    ends = np.cumsum(counts)
    return np.array([len(np.unique(hashes[a:b])) / (b - a) if b > a else 1.0
                     for a, b in zip((ends - counts).tolist(), ends.tolist())])


def text_features(values: pa.Array) -> np.ndarray:
    """One row of content features per text."""
    out = []
    for a, b in slices(values, _SLICE):
        part = values.slice(a, b - a)
        data, offs = utf8(part)
        lens = np.diff(offs)
        row = np.repeat(np.arange(len(part)), lens)
        kinds = np.bincount(row * _N_KINDS + _KIND[data], minlength=len(part) * _N_KINDS)
        shares = np.sqrt(kinds.reshape(len(part), _N_KINDS) / np.maximum(lens, 1)[:, None])
        words, n_words = word_hashes(part, BLANKS)
        lines, n_lines = word_hashes(part, _LINES)
        doc = np.repeat(np.arange(len(part)), n_words)
        pairs = (words[:-1] * np.uint64(3) + words[1:])[doc[:-1] == doc[1:]]
        out.append(np.column_stack([
            shares, np.log1p(lens), np.log1p(n_words), lens / np.maximum(n_words, 1) / 10,
            _distinct_share(words, n_words), _distinct_share(pairs, np.maximum(n_words - 1, 0)),
            _distinct_share(lines, n_lines), np.log1p(lens / np.maximum(n_lines, 1))]))
    return np.concatenate(out).astype(np.float32) if out else np.zeros((0, _N_KINDS + 7), np.float32)


@F.arrow_udf(ArrayType(FloatType()))
def _content(text: pa.Array) -> pa.Array:
    x = text_features(text)
    offs = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
    return pa.ListArray.from_arrays(offs, pa.array(x.reshape(-1)))


def _metadata(source: Column, lang: Column, n_chars: Column) -> Column:
    """Hashed one-hot source and language, recorded length; null has a slot of its own."""
    def slot(c: Column, n: int) -> list[Column]:
        at = F.when(c.isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(c), F.lit(n - 1)))
        return [(at == k).cast("float") for k in range(n)]

    size = F.log1p(F.greatest(n_chars.cast("double"), F.lit(0.0)))
    size = F.coalesce(size, F.lit(0.0))
    return F.array(*slot(source.cast("string"), SOURCE_SLOTS), *slot(lang.cast("string"), LANG_SLOTS),
                   size.cast("float"), (size * size / 10).cast("float"),
                   n_chars.isNull().cast("float"))


def with_views(docs: DataFrame, content: str, metadata: str, text_col: str = "text",
               meta_cols: Sequence[str] = ("source", "lang", "n_chars")) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return (docs.withColumn(content, _content(text))
            .withColumn(metadata, _metadata(*[F.col(c) for c in meta_cols])))


_SCORES = StructType([StructField(n, DoubleType()) for n in ("content", "metadata", "both")])


def _rows(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy().reshape(len(vectors), -1) if len(vectors) else \
        np.zeros((0, 1))


@dataclass
class QualityModel:
    """Weights and intercept of both views, their calibration, and the share of good ones."""

    views: list[tuple[np.ndarray, float]]
    scales: list[tuple[float, float]]
    prior: float

    def score(self, content: Column, metadata: Column) -> Column:
        """Struct (content, metadata, both): probabilities of good quality."""
        model = self

        @F.arrow_udf(_SCORES)
        def run(x: pa.Array, z: pa.Array) -> pa.Array:
            return model._scores(_rows(x), _rows(z))

        # else Spark copies it into each filter by a score: a Python worker more in every task
        return run.asNondeterministic()(content, metadata)

    def score_text(self, text: Column, metadata: Column) -> Column:
        """The same from the text itself, in one step."""
        model = self

        @F.arrow_udf(_SCORES)
        def run(text: pa.Array, z: pa.Array) -> pa.Array:
            return model._scores(text_features(text), _rows(z))

        return run(text, metadata)

    def _scores(self, *views: np.ndarray) -> pa.Array:
        logits = [(v.astype(float) @ w + b) * slope + shift
                  for v, (w, b), (slope, shift) in zip(views, self.views, self.scales)]
        logits.append(logits[0] + logits[1] - self.prior)
        probs = [1 / (1 + np.exp(-np.clip(t, -35, 35))) for t in logits]
        return pa.StructArray.from_arrays([pa.array(p) for p in probs], _SCORES.fieldNames())


def _fit(rows: DataFrame, features: str, penalty: float) -> tuple[np.ndarray, float]:
    # imported on the driver alone: tasks need no Spark ML (and no pandas, which it loads)
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    m = (LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight",
                            maxIter=20, tol=1e-4, regParam=penalty)
         .fit(rows.select(array_to_vector(features).alias("features"),
                          F.col("label").cast("double"), F.col("weight").cast("double"))))
    return m.coefficients.toArray(), float(m.intercept)


def train(views: DataFrame, rounds: int = ROUNDS) -> QualityModel:
    """``views``: stored rows (doc_id, label or null, content, metadata).  Held-out rows
    (fold 0) are left out; fold 1 calibrates; folds 2 to 4 and all unlabelled rows train."""
    known = views.filter("label is not null").withColumn("fold", fold(F.col("doc_id")))
    known = known.filter("fold > 0")
    counts = {(r["calibrates"], r["label"]): r["n"] for r in
              known.groupBy((F.col("fold") == 1).alias("calibrates"), "label")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [_N_KINDS + 7, SOURCE_SLOTS + LANG_SLOTS + 3]
    plain = QualityModel([(np.zeros(n), 0.0) for n in sizes], [(1.0, 0.0)] * 2, 0.0)
    n = [sum(v for (_, y), v in counts.items() if y == c) for c in (0, 1)]
    if not all(counts.get((False, c)) for c in (0, 1)):
        share = (n[1] + 1) / (sum(n) + 1)  # one label or none: a constant
        level = float(np.log(share / max(1 - share, 1e-6)))
        return QualityModel(plain.views, [(1.0, level)] * 2, level)
    fitting = known.filter("fold > 1").select("label", F.lit(1.0).alias("weight"), "content", "metadata")
    free = views.filter("label is null")
    names, models, shared = ("content", "metadata"), None, [None, None]
    for _ in range(rounds):
        if models:
            p = QualityModel(models, [(1.0, 0.0)] * 2, 0.0).score(F.col("content"), F.col("metadata"))
            scored = free.withColumn("p", p)
            for k, other in enumerate(reversed(names)):
                sure = F.col(f"p.{other}")
                shared[k] = scored.filter((sure >= CONFIDENT) | (sure <= 1 - CONFIDENT)).select(
                    (sure >= 0.5).cast("int").alias("label"), F.lit(PSEUDO_WEIGHT).alias("weight"),
                    *names)
        models = [_fit(fitting if extra is None else fitting.unionByName(extra), name, 1e-4)
                  for name, extra in zip(names, shared)]
    held = known.filter("fold = 1") if all(counts.get((True, c)) for c in (0, 1)) else \
        known.filter("fold > 1")
    raw = QualityModel(models, [(1.0, 0.0)] * 2, 0.0).score(F.col("content"), F.col("metadata"))
    scored = stored(held.select("label", raw.alias("p")), "quality-calibration")
    scales = []
    for name in names:
        p = F.least(F.greatest(F.col(f"p.{name}"), F.lit(1e-9)), F.lit(1 - 1e-9))
        w, b = _fit(scored.select("label", F.lit(1.0).alias("weight"),
                                  F.array(F.log(p / (1 - p))).alias("x")), "x", 1e-3)
        scales.append((float(w[0]), b))
    return QualityModel(models, scales, float(np.log(n[1] / n[0])))


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
              meta_cols: Sequence[str]) -> DataFrame:
    ids = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col(label_col).cast("int").alias("label"))
           .filter("label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       *[F.col(c).alias(f"m{k}") for k, c in enumerate(meta_cols)])
    rows = with_views(rows, "content", "metadata", "text",
                      [f"m{k}" for k in range(len(meta_cols))]).select("doc_id", "content", "metadata")
    return stored(rows.join(ids, "doc_id", "left"), "quality-views")


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "quality",
                  meta_cols: Sequence[str] = ("source", "lang", "n_chars")) -> DataFrame:
    """(doc_id, held_out, content_score, metadata_score, score, predicted) of every row.

    Scores are probabilities of label 1; predicted is 1 from 0.5 on.  Labels of documents
    with crc32(doc_id) mod 5 = 0 are never read.  Null texts count as empty, null metadata
    is a value of its own; repeated rows get equal scores.  Without labels of both kinds
    every score is their (smoothed) share of ones, 1 without any.
    """
    views = _labelled(docs, labels, id_col, text_col, label_col, meta_cols)
    p = train(views).score(F.col("content"), F.col("metadata"))
    return (views.select("doc_id", p.alias("p"))
            .select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"),
                    F.col("p.content").alias("content_score"),
                    F.col("p.metadata").alias("metadata_score"), F.col("p.both").alias("score"),
                    (F.col("p.both") >= 0.5).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality",
              meta_cols: Sequence[str] = ("source", "lang", "n_chars")) -> DataFrame:
    """The rows of ``docs`` that score 0.5 or more; rows don't shuffle.

    A row is judged by its own text and metadata alone: null and repeated ids make no
    difference, repeated rows stay or go together, null and empty texts are judged alike,
    null metadata is a value of its own.  Without labels of both kinds every row has their
    (smoothed) share of ones.  An empty table stays empty; other columns are kept unread.
    """
    model = train(_labelled(docs, labels, id_col, text_col, label_col, meta_cols))
    names = docs.columns
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    score = model.score_text(text, _metadata(*[F.col(c) for c in meta_cols]))
    return docs.filter(score["both"] >= 0.5).select(*[F.col(f"`{c}`") for c in names])
