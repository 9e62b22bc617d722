"""Approximate nearest neighbours with a hash-prefix forest (operator 5).

Every vector has a long string of hash bits in each of several trees (signs of random
projections; vectors are lifted by one coordinate so that a large inner product means a
small angle).  A tree is the sorted array of its strings, so the rows that share a prefix
of any length with a query lie side by side, and binary search finds them.

Two passes over the trees, dealt by (tree, first bits, block):

* descending: how many rows share how long a prefix with each query, in every tree;
* ascending: all trees together, from the longest prefixes up, until a query has enough
  candidates; their exact inner products give its nearest.

Queries that have too few candidates in the first deal are dealt again by half as many bits,
and so on; those without enough on any prefix are compared with every entry, in blocks.

How many candidates are enough is fitted on a bounded sample, for its recall; every row is
indexed.  Rows with equal vectors are one entry of the index with their smallest ids, more
of which can't be among the nearest; large prefix groups are cut into blocks, and their
queries go to every block.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_by_group, stored

TREES, BITS = 16, 32
#: The sample for the fit, its queries, and the recall that it has to reach there.
SAMPLE_ROWS, SAMPLE_QUERIES, RECALL = 16_384, 128, 0.96
SHARES = (0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 1.0, 1.25, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0)
#: Candidates per tree, at least.
LEAST = 512
BLOCK_ROWS = 8192
SEED = 17


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _codes(x: np.ndarray, lift: np.ndarray) -> np.ndarray:
    """(trees, rows): the hash strings as integers, first bit highest."""
    planes = np.random.default_rng(SEED).normal(size=(TREES * BITS, x.shape[1] + 1))
    signs = (np.column_stack([x, lift]) @ planes.T > 0).reshape(len(x), TREES, BITS)
    weights = np.int64(1) << np.arange(BITS - 1, -1, -1)
    return (signs @ weights).T.astype(np.int64)


def _level_counts(code: np.ndarray, wanted: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The range of a sorted code array that shares ``level`` bits with each wanted code."""
    low = wanted >> (BITS - level) << (BITS - level)
    return np.searchsorted(code, low), np.searchsorted(code, low + (1 << (BITS - level)))


@dataclass
class Fit:
    """``share``: candidates, counted in every tree, per row of the index."""

    share: float
    recall: float

    @classmethod
    def on(cls, x: np.ndarray, norm2: float, k: int) -> Fit:
        """Smallest share with the recall asked for, of the sample's queries in the sample."""
        lift = np.sqrt(np.maximum(norm2 - (x * x).sum(1), 0))
        codes, n = _codes(x, lift), len(x)
        at = np.arange(0, n, max(1, n // SAMPLE_QUERIES))[:SAMPLE_QUERIES]
        wanted = _codes(x[at], np.zeros(len(at)))
        scores = x[at] @ x.T
        scores[np.arange(len(at)), at] = -np.inf
        k = min(k, n - 1)
        if k < 1:
            return cls(SHARES[-1], 1.0)
        best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        common = np.zeros((len(at), n), np.int8)
        totals = np.zeros((len(at), BITS + 1), np.int64)
        for t in range(TREES):
            apart = (wanted[t][:, None] ^ codes[t][None, :]).astype(np.float64)
            same = BITS - np.frexp(apart)[1]
            np.maximum(common, same, out=common, casting="unsafe")
            for level in range(BITS + 1):
                totals[:, level] += (same >= level).sum(1)
        reach = np.take_along_axis(common, best, 1)
        for share in SHARES:
            level = np.maximum((totals >= max(share * n, TREES * min(max(LEAST, k + 1), n))).sum(1) - 1, 0)
            recall = float((reach >= level[:, None]).mean())
            if recall >= RECALL:
                break
        return cls(share, recall)


def _valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec): vectors of the commonest length that can take part, equal rows once."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    usable = (F.col("vec_id").isNotNull() & F.col("vec").isNotNull()
              & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v)
                         & (F.abs(v) < F.lit(float("inf"))))
              & F.exists("vec", lambda v: v != 0))
    rows = rows.filter(usable)
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vec") == (length["n"] if length else 0)).dropDuplicates()


def nearest(vectors: DataFrame, query_where: str, k: int = 20, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``query_where`` (a SQL condition on
    vec_id) holds, its ``k`` nearest found by inner product, without itself; ties go to the
    smaller vec_id.  All others, if there are fewer than ``k``.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do
    null ids or lengths other than the commonest one.  Equal rows (id and vector) count
    once.  Scores are double-precision inner products of the vectors as given.
    """
    spark, most = vectors.sparkSession, k + 1
    rows = stored(_valid(vectors, id_col, vec_col), "forest-rows")
    place = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    firsts = rows.withColumn("place", place).filter(F.col("place") <= most)
    asked = rows.filter(query_where)
    entries = stored(firsts.groupBy("vec").agg(F.min("vec_id").alias("rep"),
                                               F.array_sort(F.collect_set("vec_id")).alias("ids")),
                     "forest-entries")
    asked_entries = asked.groupBy("vec").agg(F.count(F.lit(1)).alias("asked"))
    queries = stored(asked_entries.join(entries, "vec").select("rep", "vec", "asked"), "forest-queries")
    n = entries.count()
    norm2 = entries.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v.cast("double")
                                          * v.cast("double")))).first()[0] or 0.0
    sample = entries.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE_ROWS).select("vec").toArrow()
    fit = Fit.on(_matrix(sample["vec"]), norm2, k) if n else Fit(SHARES[-1], 1.0)
    enough = max(fit.share * n, TREES * max(LEAST, most))
    bits = min(20, max(0, int(np.log2(max(TREES * n / enough, 1))) - 1))

    def coded(lifted: bool):
        def run(batches):
            for batch in batches:
                x = _matrix(batch.column("vec"))
                lift = np.sqrt(np.maximum(norm2 - (x * x).sum(1), 0)) if lifted else np.zeros(len(x))
                codes = _codes(x, lift).T.reshape(-1) if len(x) else np.zeros(0, np.int64)
                offs = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * TREES)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.ListArray.from_arrays(offs, pa.array(codes))],
                    [*batch.schema.names, "codes"])
        return run

    def dealt(df: DataFrame, lifted: bool, bits: int) -> DataFrame:
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        return (df.mapInArrow(coded(lifted), f"{fields}, codes array<bigint>")
                .select(*df.columns, F.posexplode("codes").alias("tree", "code"))
                .withColumn("head", F.shiftright("code", BITS - bits)))

    key = ["tree", "head", "block"]

    def in_blocks(index: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Both sides with their blocks, of the heads that hold entries and queries."""
        sizes = stored(index.groupBy("tree", "head").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS)).cast("int").alias("blocks"))
            .join(wanted.select("tree", "head").distinct(), ["tree", "head"]), "forest-sizes")
        return (index.join(sizes, ["tree", "head"]).withColumn(
                    "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")),
                wanted.join(sizes, ["tree", "head"]).withColumn(
                    "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))

    def descend(bits: int, below: int):
        def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
            code, q = np.sort(rows["code"].to_numpy()), asked["code"].to_numpy()
            rep, out = asked["rep"].to_numpy(), []
            for level in range(bits, below):
                lo, hi = _level_counts(code, q, level)
                some = hi > lo
                if not some.any():
                    break
                out.append((rep[some], np.full(int(some.sum()), level), (hi - lo)[some]))
            cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
            return pa.table({"rep": cols[0].astype(np.int64), "level": cols[1].astype(np.int32),
                             "n": cols[2].astype(np.int64)})
        return run

    def ascend(rows: pa.Table, asked: pa.Table) -> pa.Table:
        order = np.argsort(rows["code"].to_numpy(), kind="stable")
        code, rep = rows["code"].to_numpy()[order], rows["rep"].to_numpy()[order]
        ids = rows["ids"].combine_chunks() if rows.num_rows else None
        found: list[tuple] = []
        if rows.num_rows and asked.num_rows:
            x, y = _matrix(rows["vec"])[order], _matrix(asked["vec"])
            q, level, name = (asked[c].to_numpy() for c in ("code", "level", "rep"))
            low = q >> (BITS - level) << (BITS - level)
            lo = np.searchsorted(code, low)
            hi = np.searchsorted(code, low + (np.int64(1) << (BITS - level).astype(np.int64)))
            for a in range(0, len(y), 256):
                scores = y[a:a + 256] @ x.T
                for i, s in enumerate(scores, a):
                    part = s[lo[i]:hi[i]]
                    top = np.arange(len(part)) if len(part) <= most + 8 else \
                        np.argpartition(-part, most + 7)[:most + 8]
                    top = top + lo[i]
                    exact = (x[top] * y[i]).sum(1)
                    by = np.lexsort((rep[top], -exact))[:most]
                    found.append((np.full(len(by), name[i]), order[top[by]], exact[by]))
        cols = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0)] * 3
        got = ids.take(pa.array(cols[1].astype(np.int64))) if found else \
            pa.array([], pa.list_(pa.int64()))
        return pa.table({"rep": cols[0].astype(np.int64), "ids": got, "score": cols[2].astype(float)})

    def scored(index: DataFrame, asked_at: DataFrame) -> DataFrame:
        return stored(index.select(*key, "code", "rep", "ids", "vec").groupBy(*key)
                      .cogroup(asked_at.select(*key, "code", "rep", "vec", "level").groupBy(*key))
                      .applyInArrow(ascend, "rep bigint, ids array<bigint>, score double"),
                      "forest-found")

    index_rows, parts = entries.select("rep", "ids", "vec"), []
    pending, below = queries.select("rep", "vec"), BITS + 1
    while True:
        index, wanted = in_blocks(dealt(index_rows, True, bits), dealt(pending, False, bits))
        counted = (index.select(*key, "code").groupBy(*key)
                   .cogroup(wanted.select(*key, "code", "rep").groupBy(*key))
                   .applyInArrow(descend(bits, below), "rep bigint, level int, n bigint"))
        depth = stored(counted.groupBy("rep", "level").agg(F.sum("n").alias("n"))
                       .filter(F.col("n") >= enough).groupBy("rep").agg(F.max("level").alias("level")),
                       "forest-depth")
        parts.append(scored(index, wanted.join(depth, "rep")))
        pending = stored(pending.join(depth, "rep", "left_anti"), "forest-pending")
        if not bits or pending.isEmpty():
            break
        bits, below = bits // 2, bits
    if not pending.isEmpty():
        # level 0 of one tree holds every entry
        whole = lambda df: df.withColumns({"tree": F.lit(0), "head": F.lit(0).cast("bigint"),
                                           "code": F.lit(0).cast("bigint")})
        index, wanted = in_blocks(whole(index_rows), whole(pending))
        parts.append(scored(index, wanted.withColumn("level", F.lit(0))))
    found = reduce(DataFrame.unionByName, parts)
    found = (found.select("rep", F.explode("ids").alias("vec_id"), "score")
             .groupBy("rep", "vec_id").agg(F.max("score").alias("score")))
    best = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    lists = (found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= most)
             .groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score")))
                                 .alias("list"))
             .join(queries.select("rep", "asked"), "rep"))
    by_rep = asked.join(queries.select("rep", "vec"), "vec").select("vec_id", "rep")
    answers = join_by_group(by_rep, stored(lists, "forest-lists"), "rep", "asked", max(n, 1))
    return (answers.select(F.col("vec_id").alias("query_id"), F.posexplode(
        F.slice(F.filter("list", lambda e: e["vec_id"] != F.col("vec_id")), 1, k)).alias("pos", "hit"))
        .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                F.col("hit.score").alias("score")))
