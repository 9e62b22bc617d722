"""Exact de-duplication with a two-pass Bloom filter (operator 10).

Pass one sets, for every text hash, one position in each half of a bit table and keeps the
positions that two or more rows hit.  Pass two tests every row against them: a row with a
position hit only once has no equal, so it passes straight through.  Only the possibly
repeated rows shuffle, on the full SHA-256, which decides exactly.

The table is bounded: at most ``filter_bits`` bits reach an executor.  Larger inputs are
split by hash into shards, each with its own filter of that size over its own rows.

Groups that hold more than 1/``HOT_SHARE`` of the rows (so at most ``HOT_SHARE`` of them)
are joined by broadcast; all others shuffle, and none of them can dominate a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, StructField, StructType

from .common import id_text, fresh, stored

BITS_PER_ROW = 16
FILTER_BITS = 1 << 27
HOT_SHARE = 1000


def _digests(text: pa.Array) -> list[bytes]:
    # bytes.lower() changes A-Z only
    return [hashlib.sha256((t or b"").lower()).digest()
            for t in text.cast(pa.large_binary()).to_pylist()]


@F.arrow_udf(BinaryType())
def _sha256(text: pa.Array) -> pa.Array:
    return pa.array(_digests(text), pa.binary())


def _half(sha: Column, part: int) -> Column:
    """Eight bytes of the digest as a non-negative BIGINT."""
    return F.conv(F.substring(F.hex(sha), 1 + 15 * part, 15), 16, 10).cast("long")


def text_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, rid, sha, h0, h1) of every row; ``rid`` tells repeated rows apart."""
    return (id_text(docs, id_col, text_col).select("doc_id", _sha256("text").alias("sha"))
            .select("doc_id", F.monotonically_increasing_id().alias("rid"), "sha",
                    _half(F.col("sha"), 0).alias("h0"), _half(F.col("sha"), 1).alias("h1")))


class RepeatFilter:
    """The positions that two or more rows hit, by shard."""

    def __init__(self, bits: int, shards: int, tables: list):
        self.bits, self.shards, self.tables = bits, shards, tables

    @staticmethod
    def positions(h0: Column, h1: Column, bits: int) -> list[Column]:
        return [F.pmod(h0, F.lit(bits // 2)), F.pmod(h1, F.lit(bits // 2)) + bits // 2]

    def shard(self, h0: Column) -> Column:
        return F.pmod(F.shiftright(h0, 40), F.lit(self.shards)).cast("int")

    @classmethod
    def build(cls, keys: DataFrame, filter_bits: int = FILTER_BITS) -> RepeatFilter:
        """Pass one over (h0, h1).  Each shard's table comes to the driver as at most
        ``bits / 64`` words and is broadcast."""
        spark, wanted = keys.sparkSession, BITS_PER_ROW * max(keys.count(), 64)
        shards = -(-wanted // filter_bits)
        bits = 1 << (-(-wanted // shards) - 1).bit_length()
        out = cls(bits, shards, [])
        for s in range(shards):
            rows = keys.filter(out.shard(F.col("h0")) == s) if shards > 1 else keys
            hit = (rows.select(F.explode(F.array(*cls.positions(F.col("h0"), F.col("h1"), bits)))
                               .alias("pos"))
                   .groupBy("pos").count().filter("count > 1")
                   .groupBy(F.shiftright("pos", 6).alias("word"))
                   .agg(F.bit_or(F.expr("shiftleft(1L, cast(pos % 64 as int))")).alias("mask")))
            got = hit.toArrow()
            words = np.zeros(bits // 64, np.uint64)
            words[got["word"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
            out.tables.append(spark.sparkContext.broadcast(words))
        return out

    def tested(self, text: Column) -> Column:
        """Struct (sha, maybe) of a text: its digest, and False only where no other row has
        the same one."""
        bits, shards, tables = self.bits, self.shards, self.tables

        @F.arrow_udf(StructType([StructField("sha", BinaryType()), StructField("maybe", BooleanType())]))
        def run(text: pa.Array) -> pa.Array:
            digests = _digests(text)
            x = [int.from_bytes(d[:15], "big") for d in digests]
            h = np.array([[v >> 60, v & (1 << 60) - 1] for v in x], np.int64).reshape(-1, 2)
            shard, maybe = (h[:, 0] >> 40) % shards, np.ones(len(x), bool)
            for s in np.unique(shard):
                at, words = shard == s, tables[s].value
                for p in (h[at, 0] % (bits // 2), h[at, 1] % (bits // 2) + bits // 2):
                    maybe[at] &= (words[p >> 6] >> (p & 63).astype(np.uint64) & np.uint64(1)) > 0
            return pa.StructArray.from_arrays([pa.array(digests, pa.binary()), pa.array(maybe)],
                                              ["sha", "maybe"])

        # else Spark copies it into the filter by ``maybe``: a Python worker more in every task
        return run.asNondeterministic()(text)

    def maybe_repeated(self, h0: Column, h1: Column) -> Column:
        """False only where no other row has the same hash."""
        tables = self.tables

        @F.arrow_udf(BooleanType())
        def test(shard: pa.Array, p0: pa.Array, p1: pa.Array) -> pa.Array:
            shard, out = shard.to_numpy(), np.ones(len(shard), bool)
            for s in np.unique(shard):
                at, words = shard == s, tables[s].value
                for p in (p0, p1):
                    p = p.to_numpy()[at]
                    out[at] &= (words[p >> 6] >> (p & 63).astype(np.uint64) & np.uint64(1)) > 0
            return pa.array(out)

        return test(self.shard(h0), *self.positions(h0, h1, self.bits))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.  The row
    with the largest doc_id stays; of repeated rows with that doc_id exactly one does; a
    null doc_id is smaller than any other.  An empty table gives an empty result; other
    columns are ignored, whatever their names.
    """
    keys = stored(text_keys(docs, id_col, text_col), "dedup-keys")
    filt = RepeatFilter.build(keys, filter_bits)
    maybe = stored(keys.filter(filt.maybe_repeated(F.col("h0"), F.col("h1")))
                   .select("doc_id", "rid", "sha"), "dedup-maybe")
    groups = stored(maybe.groupBy("sha").agg(F.max(F.struct("doc_id", "rid")).alias("keep"),
                                             F.count(F.lit(1)).alias("group_size")),
                    "dedup-groups")
    least_hot = max(1, maybe.count() // HOT_SHARE)
    hot = F.broadcast(groups.filter(F.col("group_size") > least_hot))  # < HOT_SHARE rows
    cold = groups.filter(F.col("group_size") <= least_hot)
    out = [F.col("doc_id"), F.col("keep.doc_id").alias("keep_id"), F.col("group_size"),
           (F.col("rid") == F.col("keep.rid")).alias("kept"),
           F.lower(F.hex("sha")).alias("text_sha256")]
    alone = (keys.filter(~filt.maybe_repeated(F.col("h0"), F.col("h1")))
             .select("doc_id", F.col("doc_id").alias("keep_id"),
                     F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
                     F.lower(F.hex("sha")).alias("text_sha256")))
    return (alone.unionByName(maybe.join(hot, "sha").select(*out))
            .unionByName(maybe.join(hot.select("sha"), "sha", "left_anti").join(cold, "sha")
                         .select(*out)))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                filter_bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the largest doc_id.

    Unrepeated rows pass without a shuffle; of the possibly repeated ones each task first
    keeps its own best row per text, so a group of any size reaches the shuffle as one row
    per task.
    """
    names = docs.columns
    filt = RepeatFilter.build(stored(text_keys(docs, id_col, text_col).select("h0", "h1"),
                                     "dedup-hashes"), filter_bits)
    test, sha, row = fresh("_test", names), fresh("_sha", names), fresh("_row", names)
    keyed = docs.withColumn(test, filt.tested(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    maybe = F.col(test)["maybe"]
    cols = [F.col(f"`{c}`") for c in names]
    best = F.struct(F.col(id_col).cast("long"), F.xxhash64(*cols))
    once = (keyed.filter(maybe).withColumn(sha, F.col(test)["sha"]).groupBy(sha).agg(F.max_by(F.struct(*cols), best).alias(row))
            .select(*[F.col(row)[c].alias(c) for c in names]))
    return keyed.filter(~maybe).select(*cols).unionByName(once)
