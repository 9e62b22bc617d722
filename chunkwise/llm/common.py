"""Helpers shared by the operators: stored tables, Arrow buffers, vectorised word hashes."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import BooleanType

from chunkwise.session import scratch_path

#: ``[^\x20\x09-\x0D]+``: a word is a run of characters other than these six.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text handled at once inside a task.
CHUNK_BYTES = 1 << 20
#: Bytes of a batch that Spark hands to a Python worker (Spark's 64 MB hold whole tasks, in
#: the executor, whose buffers grow by doubling, and again in the worker).
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MULT_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ONE = np.uint64(1)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors (once a session): task functions import it there.
    Only the driver reads the archive; Spark passes it on, as with ``--py-files``.  The
    session's Arrow batches get ``BATCH_BYTES``, unless its user has set their size."""
    sc = spark.sparkContext
    if _BATCH_CONF not in spark.conf.getAll:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in root.rglob("*.py"):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))


def table(spark: SparkSession, sf_dir, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: a cut in the lineage that
    survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Words of a text as BIGINT (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id BIGINT, text STRING, null as empty): other columns never reach an operator."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def fresh(name: str, columns) -> str:
    """A column name that clashes with none of ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null is empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if values.null_count:
        values = values.fill_null("")
    values = values.cast(pa.large_binary())
    offs = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    buf = values.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]] if len(offs) else data[:0], offs - offs[0] if len(offs) else offs


def slices(values: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text each (at least one row)."""
    _, offs = utf8(values)
    at = 0
    while at < len(values):
        end = int(np.searchsorted(offs, offs[at] + most, "right")) - 1
        end = min(max(end, at + 1), len(values))
        yield at, end
        at = end


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (all bits depend on all bits)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Bytes that end a word: the six of WORD, or every ASCII byte that is no letter or digit.
BLANKS = np.isin(np.arange(256), [32, *range(9, 14)])
NON_LETTERS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def word_hashes(values: pa.Array, breaks: np.ndarray = BLANKS, prefixes: tuple[int, ...] = ()):
    """64-bit hashes of all words (A-Z lower-cased) of a string array, in order, and the
    number of words of each row.  Prefix sums of byte * M**position give every word's
    polynomial in a few passes over the bytes; arithmetic wraps at 2**64.  With
    ``prefixes``, also a list of (hashes, word numbers): for each length, the first bytes
    of the words that are longer."""
    data, offs = utf8(values)
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.uint64)
        out = (empty, np.zeros(len(values), np.int64))
        return (*out, [(empty, np.zeros(0, np.int64)) for _ in prefixes]) if prefixes else out
    low = data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
    inside = ~breaks[data]
    first = np.zeros(n + 1, bool)
    first[offs] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:n]
    starts = np.flatnonzero(begins)
    closes = inside
    closes[:-1] &= ~closes[1:] | first[1:n]
    ends = np.flatnonzero(closes) + 1
    with np.errstate(over="ignore"):
        powers = np.full(n, _MULT, np.uint64)
        powers[0] = _ONE
        np.cumprod(powers, out=powers)
        powers *= low.astype(np.uint64) + _ONE
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(powers, out=sums[1:])
        down = np.full(n, _MULT_INV, np.uint64)
        down[0] = _ONE
        down = np.cumprod(down)[starts]
        hashes = mix64((sums[ends] - sums[starts]) * down)
        counts = np.diff(np.searchsorted(starts, offs))
        if not prefixes:
            return hashes, counts
        parts = []
        for length in prefixes:
            at = np.flatnonzero(ends - starts > length)
            parts.append((mix64((sums[starts[at] + length] - sums[starts[at]]) * down[at]
                                + np.uint64(length)), at))
    return hashes, counts, parts


_BLOCK = 4096


def array_blocks(values: np.ndarray) -> pa.RecordBatch:
    """A task's array of float64 as (block, lane, cells) rows for ``sum_arrays``."""
    parts = [values[k:k + _BLOCK] for k in range(0, len(values), _BLOCK)]
    lane = TaskContext.get().partitionId() % 16
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(parts))), pa.array(np.full(len(parts), lane)),
         pa.array([p.astype(np.float64).tobytes() for p in parts], pa.binary())],
        ["block", "lane", "cells"])


BLOCKS = "block bigint, lane bigint, cells binary"


def sum_arrays(blocks: DataFrame, length: int) -> np.ndarray:
    """The sum of all tasks' arrays, block by block in two steps, so that no task gets the
    blocks of all others; the driver gets one array."""

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_buffer(), np.float64) for c in rows["cells"])
        return pa.table({"block": rows["block"].slice(0, 1), "cells": [total.tobytes()]},
                        schema=pa.schema([("block", pa.int64()), ("cells", pa.binary())]))

    out, schema = np.zeros(length), "block bigint, cells binary"
    sums = (blocks.groupBy("block", "lane").applyInArrow(add, schema)
            .groupBy("block").applyInArrow(add, schema)).toArrow()
    for block, part in zip(sums["block"].to_pylist(), sums["cells"].to_pylist()):
        out[block * _BLOCK:(block + 1) * _BLOCK] = np.frombuffer(part, np.float64)
    return out


class HashFilter:
    """A Bloom filter over 64-bit hashes, of at most ``MOST_BITS`` bits whatever the input:
    it comes to the driver as at most that many bits and is broadcast.  With more hashes
    than it has room for it says "maybe" more often, never a wrong "no"."""

    MOST_BITS = 1 << 27
    BITS_PER_HASH = 16

    def __init__(self, half: int, words):
        self.half, self.words = half, words

    @classmethod
    def build(cls, hashes: DataFrame) -> HashFilter:
        """``hashes``: a frame with one BIGINT column of well mixed values."""
        x = F.col(hashes.columns[0])
        wanted = min(cls.MOST_BITS, cls.BITS_PER_HASH * max(hashes.count(), 64))
        half = 1 << ((wanted - 1).bit_length() - 1)
        pos = F.array(x.bitwiseAND(F.lit(half - 1)),
                      F.shiftright(x, 31).bitwiseAND(F.lit(half - 1)) + half)
        got = (hashes.select(F.explode(pos).alias("pos"))
               .groupBy(F.shiftright("pos", 6).alias("word"))
               .agg(F.bit_or(F.expr("shiftleft(1L, cast(pos % 64 as int))")).alias("mask"))).toArrow()
        words = np.zeros(2 * half // 64, np.uint64)
        words[got["word"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
        return cls(half, hashes.sparkSession.sparkContext.broadcast(words))

    def test(self, x: np.ndarray) -> np.ndarray:
        """False only for hashes that were not put in."""
        words, out = self.words.value, np.ones(len(x), bool)
        for pos in (x & (self.half - 1), ((x >> 31) & (self.half - 1)) + self.half):
            out &= (words[pos >> 6] >> (pos & 63).astype(np.uint64) & _ONE) > 0
        return out

    def maybe(self, x: Column) -> Column:
        test = self.test

        @F.arrow_udf(BooleanType())
        def run(values: pa.Array) -> pa.Array:
            return pa.array(test(values.to_numpy(zero_copy_only=False)))

        return run(x)


def join_by_group(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` (one row per key, ``size`` rows each) in which
    no key dominates a task: groups of more than a thousandth of all rows, of which there
    are fewer than a thousand, are broadcast; the others shuffle."""
    least_hot = max(1, n_rows // 1000)
    hot = F.broadcast(groups.filter(F.col(size) > least_hot))
    cold = groups.filter(F.col(size) <= least_hot)
    return (rows.join(hot, key)
            .unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key)))
