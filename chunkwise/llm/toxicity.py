"""Toxicity scores from a factorization machine over hashed terms (operator 1).

Terms are the distinct lower-cased words of the whole text and the first 4, 5 and 6 bytes
of longer words (so inflected forms share a term), as 32-bit hashes.  The machine adds to
the linear weights a product of learned factors for every pair of terms, so an insult can
weigh more next to the mention of a group than either does alone:

    logit = b + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)

with x_i (0 to 1) how surely the term's share of toxic training documents differs from the
whole sample's, so that the many common terms of a long text don't drown the few that matter.
Terms of a pair whose joint counts tell more than either term and their sum count in full,
whatever each says alone.

It is trained in numpy on a bounded sample of labelled documents; scoring is one pass over
all documents without a shuffle, the weights broadcast: every term of ``LEAST_DOCS`` training
documents has one, so there are at most ``MAX_TERMS / LEAST_DOCS``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NON_LETTERS, id_text, slices, stored, word_hashes

if TYPE_CHECKING:
    import pandas as pd

#: Bounds of the training sample: documents of each label, and distinct terms of all of them.
MAX_DOCS_PER_LABEL = 10_000
MAX_TERMS = 6_000_000
#: A document with more than this share of a label's half of the terms comes after all others.
LONG = 0.01
#: Terms of fewer training documents have no weight.
LEAST_DOCS = 4
FACTORS = 4
#: Standard deviations from which a term counts in full.
SURE = 6
EPOCHS = 8
#: Wrong pairs of terms expected among all that are compared.
CHANCE = 1e-3
#: First size of the factors, and of those of terms that count for a pair.
SPREAD, PAIR_SPREAD = 0.01, 0.3
PREFIXES = (4, 5, 6)


def doc_terms(values: pa.Array) -> list[np.ndarray]:
    """The distinct term hashes of each text, sorted."""
    words, counts, parts = word_hashes(values, NON_LETTERS, PREFIXES)
    doc = np.repeat(np.arange(len(values)), counts)
    term = np.concatenate([words, *(h for h, _ in parts)])
    doc = np.concatenate([doc, *(doc[at] for _, at in parts)]).astype(np.uint64)
    key = np.unique(doc << np.uint64(32) | term >> np.uint64(32))
    cuts = np.searchsorted(key, np.arange(len(values) + 1, dtype=np.uint64) << np.uint64(32))
    term = key.astype(np.uint32)
    return [term[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _divergence(t: np.ndarray, n: np.ndarray, q: np.ndarray) -> np.ndarray:
    """n * KL(t / n, q): how unlikely t toxic of n documents are at a share of q."""
    q, u = np.clip(q, 1e-9, 1 - 1e-9), n - t
    return (t * np.log(np.maximum(t, 1) / (np.maximum(n, 1) * q))
            + u * np.log(np.maximum(u, 1) / (np.maximum(n, 1) * (1 - q))))


def pair_terms(index: list[np.ndarray], labels: np.ndarray, n_terms: int) -> np.ndarray:
    """Which terms belong to a pair whose documents are toxic more or less often than the
    whole sample's, either term's, and than both terms' log odds added say.  All pairs that
    could tell so much are counted: with fewer documents no count would be sure enough."""
    out = np.zeros(n_terms, bool)
    lens = np.array([len(d) for d in index])
    if not lens.sum() or labels.min() == labels.max():
        return out
    share = labels.mean()
    flat, doc = np.concatenate(index), np.repeat(np.arange(len(index)), lens)
    seen = np.bincount(flat, minlength=n_terms)
    sure = lambda terms: np.log(max(terms * (terms - 1) / 2, 1) / CHANCE)
    # a pair of n documents of one label tells at most n * -log(that label's share)
    most, least = -np.log(min(share, 1 - share)), LEAST_DOCS
    while True:
        need = sure(int((seen >= least).sum()))
        more = max(LEAST_DOCS, int(np.ceil(need / most)))
        if more <= least:
            break
        least = more
    kept = np.flatnonzero(seen >= least)
    kept = kept[np.argsort(seen[kept], kind="stable")]  # a term is counted with the more frequent
    place = np.full(n_terms, -1)
    place[kept] = np.arange(len(kept))
    at = place[flat]
    doc, at = doc[at >= 0], at[at >= 0]
    if not len(at):
        return out
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order].astype(np.int32)
    ends = np.searchsorted(doc, doc, "right")
    n1 = np.bincount(at, minlength=len(kept))
    t1 = np.bincount(at, labels[doc], len(kept))
    odds = lambda t, n: np.log((t + 0.5) / (n - t + 0.5))
    lone, base = odds(t1, n1), odds(labels.sum(), len(labels))
    by = np.lexsort((doc, at))
    cuts = np.searchsorted(at[by], np.arange(len(kept) + 1))
    good = labels[doc] > 0
    for i in range(len(kept) - 1):
        mine = by[cuts[i]:cuts[i + 1]]
        counts = []
        for rows in (mine[good[mine]], mine[~good[mine]]):
            parts = [at[a + 1:b] for a, b in zip(rows.tolist(), ends[rows].tolist())]
            counts.append(np.bincount(np.concatenate(parts), minlength=len(kept)) if parts
                          else np.zeros(len(kept), np.int64))
        j = np.flatnonzero(counts[0] + counts[1] >= least)
        if not len(j):
            continue
        t, n = counts[0][j].astype(float), (counts[0] + counts[1])[j].astype(float)
        told = np.minimum.reduce([
            _divergence(t, n, np.full(len(j), share)), _divergence(t, n, t1[j] / n1[j]),
            _divergence(t, n, np.full(len(j), t1[i] / n1[i])),
            _divergence(t, n, 1 / (1 + np.exp(-(lone[i] + lone[j] - base))))])
        j = j[told >= need]
        if len(j):
            out[kept[i]] = out[kept[j]] = True
    return out


@dataclass
class FactorizationMachine:
    terms: np.ndarray      # sorted hashes
    evidence: np.ndarray
    linear: np.ndarray
    factors: np.ndarray    # (terms, FACTORS)
    bias: float

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        lens = np.array([len(d) for d in docs])
        flat = np.concatenate(docs) if len(docs) else np.zeros(0, np.uint32)
        at = np.minimum(np.searchsorted(self.terms, flat), max(len(self.terms) - 1, 0))
        known = self.terms[at] == flat if len(self.terms) else np.zeros(len(flat), bool)
        doc = np.repeat(np.arange(len(docs)), lens)[known]
        return 1 / (1 + np.exp(-np.clip(self._logit(at[known], doc, len(docs)), -35, 35)))

    def _logit(self, at: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        x = self.evidence[at]
        out = self.bias + np.bincount(doc, self.linear[at] * x, n)
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f] * x
            out += 0.5 * (np.bincount(doc, v, n) ** 2 - np.bincount(doc, v * v, n))
        return out

    @classmethod
    def train(cls, docs: list[np.ndarray], labels: np.ndarray, weights: np.ndarray,
              seed: int = 11) -> FactorizationMachine:
        """Adagrad on the weighted logistic loss, in mini-batches."""
        share = float((weights * labels).sum() / weights.sum())
        bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        flat = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
        terms, seen = np.unique(flat, return_counts=True)
        terms = terms[seen >= LEAST_DOCS]
        rng = np.random.default_rng(seed)
        m = cls(terms, np.zeros(len(terms)), np.zeros(len(terms)),
                rng.normal(0, SPREAD, (len(terms), FACTORS)), bias)
        if not len(terms) or share in (0.0, 1.0):
            m.factors[:] = 0
            return m
        index = []
        for d in docs:
            at = np.minimum(np.searchsorted(terms, d), len(terms) - 1)
            index.append(at[terms[at] == d].astype(np.int32))
        # weighted toxic documents of a term against their expected number, in deviations
        lens = np.array([len(x) for x in index])
        at = np.concatenate(index)
        toxic = np.bincount(at, np.repeat(weights * labels, lens), len(terms))
        spread = np.bincount(at, np.repeat(weights ** 2, lens), len(terms)) * share * (1 - share)
        expected = np.bincount(at, np.repeat(weights, lens), len(terms)) * share
        m.evidence = np.minimum(1, ((toxic - expected) ** 2 / (spread * SURE ** 2)) ** 2)
        paired = pair_terms(index, labels, len(terms))
        m.factors[paired & (m.evidence < 1)] *= PAIR_SPREAD / SPREAD
        m.evidence[paired] = 1
        g_lin, g_fac, g_bias = np.full(len(terms), 1e-3), np.full(m.factors.shape, 1e-3), 1e-3
        for epoch in range(EPOCHS):
            order = rng.permutation(len(docs))
            for k in range(0, len(order), 64):
                batch = order[k:k + 64]
                lens = np.array([len(index[i]) for i in batch])
                at = np.concatenate([index[i] for i in batch])
                doc = np.repeat(np.arange(len(batch)), lens)
                rows, back = np.unique(at, return_inverse=True)
                err = (1 / (1 + np.exp(-np.clip(m._logit(at, doc, len(batch)), -35, 35)))
                       - labels[batch]) * weights[batch] / len(batch)
                m.bias -= 0.05 * err.sum() / np.sqrt(g_bias := g_bias + err.sum() ** 2)
                x = m.evidence[at]
                grad = np.bincount(back, err[doc] * x, len(rows)) + 1e-5 * m.linear[rows]
                g_lin[rows] += grad ** 2
                m.linear[rows] -= 0.3 * grad / np.sqrt(g_lin[rows])
                for f in range(FACTORS):
                    v = m.factors[at, f] * x
                    total = np.bincount(doc, v, len(batch))
                    grad = (np.bincount(back, err[doc] * (total[doc] - v) * x, len(rows))
                            + 1e-4 * m.factors[rows, f])
                    g_fac[rows, f] += grad ** 2
                    m.factors[rows, f] -= 0.02 * grad / np.sqrt(g_fac[rows, f])
        return m


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, mod 5; null ids count as held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5, F.lit(0))


def chosen_places(sizes: pd.DataFrame) -> pd.DataFrame:
    """The rows of ``sizes`` (label, place, n) that are trained on: each label has half of
    ``MAX_TERMS``, and what the other one leaves of its half, for its documents in the order
    of their places; a document that does not fit is passed over."""
    import pandas as pd  # on the driver alone

    half = MAX_TERMS // 2
    total = {c: int(sizes["n"][sizes["label"] == c].sum()) for c in (0, 1)}
    out = []
    for c in (0, 1):
        mine = sizes[sizes["label"] == c]
        mine = mine.assign(long=mine["n"] > LONG * half).sort_values(["long", "place"])
        room, keep = half + max(0, half - total[1 - c]), []
        for n in mine["n"]:
            keep.append(n <= room)
            room -= n if keep[-1] else 0
        out.append(mine[np.array(keep, bool)])
    return pd.concat(out)[["label", "place"]]


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str) -> tuple[list, np.ndarray, np.ndarray]:
    """(terms, labels, weights) of at most ``MAX_DOCS_PER_LABEL`` documents of each label, in
    the order of a hash of their ids, each label within its part of ``MAX_TERMS``.  Weights
    restore each label's share of all labelled rows."""
    labelled = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                              F.col(label_col).cast("int").alias("label"))
                .filter("label in (0, 1)").filter(fold(F.col("doc_id")) != 0)
                .groupBy("doc_id").agg(F.max("label").alias("label")))
    labelled = stored(labelled.withColumn("place", F.xxhash64("doc_id")), "toxic-labels")
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    some = [labelled.filter(F.col("label") == c).orderBy("place", "doc_id").limit(MAX_DOCS_PER_LABEL)
            for c in (0, 1)]
    chosen = some[0].unionByName(some[1])  # bounded: twice MAX_DOCS_PER_LABEL rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("text")):
                rows = batch.slice(a, b - a)
                terms = doc_terms(rows.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("place"), rows.column("label"),
                     pa.array([len(t) for t in terms], pa.int32()),
                     pa.array([t.tobytes() for t in terms], pa.binary())],
                    ["place", "label", "n", "terms"])

    rows = stored(docs.join(F.broadcast(chosen), "doc_id").select("place", "label", "text")
                  .mapInArrow(run, "place bigint, label int, n int, terms binary"), "toxic-sample")
    # rows of one id go together
    sizes = rows.groupBy("label", "place").agg(F.sum("n").alias("n")).toPandas()
    inside = chosen_places(sizes)
    if not len(inside):
        return [], np.zeros(0), np.zeros(0)
    inside = docs.sparkSession.createDataFrame(
        [(int(c), int(p)) for c, p in inside.itertuples(index=False)], "label int, place bigint")
    got = (rows.join(F.broadcast(inside), ["label", "place"]).select("place", "label", "terms")
           .toArrow().sort_by([("place", "ascending"), ("terms", "ascending")]))
    y = got["label"].to_numpy().astype(float)
    weight = np.array([counts.get(c, 0) / max(1, (y == c).sum()) for c in (0, 1)])
    weight = weight[y.astype(int)]
    terms = [np.frombuffer(t.as_buffer(), np.uint32) for t in got["terms"]]
    return terms, y, weight / weight.mean()


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Labels are learned from rows of ``labels`` with crc32(doc_id) mod 5 other than 0; the
    rest is held out.  A null text counts as empty and gets the score of a text without
    known terms.  Without labels of both kinds every score is their share of ones (0.5
    without any); repeated documents get equal scores; other columns are never read.
    """
    rows = id_text(docs, id_col, text_col)
    terms, y, weight = training_sample(rows, labels, label_col)
    if len(y):
        model = FactorizationMachine.train(terms, y, weight)
    else:
        model = FactorizationMachine(np.zeros(0, np.uint32), np.zeros(0), np.zeros(0),
                                     np.zeros((0, 1)), 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(shared.value.score(doc_terms(part.column(1))))],
                    ["doc_id", "score"])

    return (rows.mapInArrow(run, "doc_id bigint, score double")
            .select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))
