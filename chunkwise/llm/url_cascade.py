"""URL filter with a Bloom-filter cascade (operator 4), DataFrame functions only.

Level 1 encodes the listed keys; level 2 the keys of the universe that level 1 takes for
listed ones; level 3 the listed keys that level 2 takes for unlisted ones; and so on until
a level makes no mistake.  A key of the universe is listed exactly if the first level that
misses it is an even one (or none misses it and the last is odd), so the answer is exact
although only bit tables, and no keys, reach the rows: no join.

A level is one row with an array of 64-bit words, read as a scalar subquery.  Its size is
bounded: a cascade holds at most ``max_keys`` keys of the universe; a larger universe is
split by hash into shards that are built and applied one after another.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored

#: Bit positions per key and bits per key of every level.
HASHES = 3
BITS_PER_KEY = 8
MAX_KEYS = 4_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    path: what follows up to ``?``, ``#`` or the end.  Both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]],
                  part: int | None = None) -> Column:
    """The longest rule (host, path, verdict) that fits, as host + path (``part`` None) or
    its ``part``; null if none fits.  Rules of equal length: the first one given."""
    chain = F
    for h, p, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        chain = chain.when(fits, F.lit(h + p if part is None else (h, p, verdict)[part]))
    return F.lit(None).cast("string") if chain is F else chain


class Cascade:
    """Exact membership for the keys of a universe; see the module's text."""

    def __init__(self, shards: int, levels: list[list[tuple[int, DataFrame]]]):
        self.shards, self.levels = shards, levels

    @staticmethod
    def _positions(key: Column, level: int, bits: int) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(level), F.lit(j), key), F.lit(bits)) for j in range(HASHES)]

    @staticmethod
    def _shard(key: Column, shards: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(0), F.lit("shard"), key), F.lit(shards))

    @classmethod
    def _passes(cls, key: Column, level: int, bits: int, words: DataFrame) -> Column:
        array = words.scalar()
        hit = []
        for p in cls._positions(key, level, bits):
            word = F.get(array, F.shiftright(p, 6).cast("int"))
            hit.append(F.getbit(word, F.pmod(p, F.lit(64)).cast("int")) == 1)
        return reduce(lambda a, b: a & b, hit)

    @classmethod
    def _encode(cls, keys: DataFrame, level: int, bits: int) -> DataFrame:
        """One row: the bit table as an array of bits / 64 words."""
        spark = keys.sparkSession
        set_words = (keys.select(F.explode(F.array(*cls._positions(F.col("key"), level, bits)))
                                 .alias("pos"))
                     .groupBy(F.shiftright("pos", 6).alias("word"))
                     .agg(F.bit_or(F.expr("shiftleft(1L, cast(pos % 64 as int))")).alias("mask")))
        dense = (spark.range(bits // 64).withColumnRenamed("id", "word")
                 .join(set_words, "word", "left")
                 .select(F.struct("word", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))
                         .alias("entry")))
        return stored(dense.agg(F.array_sort(F.collect_list("entry")).alias("entries"))
                      .select(F.transform("entries", lambda e: e["mask"]).alias("words")),
                      "cascade-level")

    @classmethod
    def build(cls, listed: DataFrame, universe: DataFrame, max_keys: int = MAX_KEYS) -> Cascade:
        """``listed`` and ``universe``: frames whose first column is the key (null keys and
        repeated ones don't count).  Listed keys belong to the universe."""
        one = lambda df, flag: df.select(F.col(df.columns[0]).cast("string").alias("key"),
                                         F.lit(flag).alias("listed"))
        keys = stored(one(listed, True).unionByName(one(universe, False)).filter("key is not null")
                      .groupBy("key").agg(F.max("listed").alias("listed")), "cascade-keys")
        shards = max(1, -(-keys.count() // max_keys))
        levels = []
        for s in range(shards):
            left = keys.filter(cls._shard(F.col("key"), shards) == s) if shards > 1 else keys
            made: list[tuple[int, DataFrame]] = []
            while n := (todo := left.filter(F.col("listed") == (len(made) % 2 == 0))).count():
                if len(made) == 64:
                    raise ValueError("keys that no level tells apart")
                level, bits = len(made) + 1, 1 << max(9, (BITS_PER_KEY * n - 1).bit_length())
                words = cls._encode(todo, level, bits)
                made.append((bits, words))
                left = left.filter((F.col("listed") == (level % 2 == 1))
                                   | cls._passes(F.col("key"), level, bits, words))
            levels.append(made)
        return cls(shards, levels)

    def _listed(self, key: Column, shard: int) -> Column:
        answer = F.lit(len(self.levels[shard]) % 2 == 1)
        for i in range(len(self.levels[shard]), 0, -1):
            bits, words = self.levels[shard][i - 1]
            answer = F.when(self._passes(key, i, bits, words), answer).otherwise(F.lit(i % 2 == 0))
        return answer

    def mark(self, df: DataFrame, key: Column, name: str) -> DataFrame:
        """``df`` with the boolean column ``name``: is the key listed?  Exact for the keys
        of the universe; a null key is not listed.  Several shards: one pass over ``df``
        and one written part each, so no more than one shard's tables are in use."""
        parts = []
        for s in range(self.shards):
            rows = df if self.shards == 1 else df.filter(
                F.coalesce(self._shard(key, self.shards), F.lit(0)) == s)
            rows = rows.withColumn(name, key.isNotNull() & self._listed(key, s))
            parts.append(rows if self.shards == 1 else stored(rows, "cascade-marked"))
        return reduce(DataFrame.unionByName, parts)


def repeated_addresses(pages: DataFrame, url_col: str = "url") -> tuple[DataFrame, DataFrame]:
    """(listed, universe): all addresses (host + path) of the corpus, and those that two or
    more rows share, crawled again under another scheme, query or fragment."""
    host, path = host_path(F.col(url_col).cast("string"))
    counts = stored(pages.select(host.alias("host"), path.alias("path")).filter("host <> ''")
                    .groupBy(F.concat("host", "path").alias("key")).count(), "url-addresses")
    return counts.filter("count > 1").select("key"), counts.select("key")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], cascade: Cascade,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row.

    The longest fitting rule decides; without one, the cascade: ``block`` if the address
    (host + path) is listed, else ``allow``.  A null url or one without ``://`` has an empty
    host and path, fits no rule and is allowed.  Other columns are ignored.
    """
    url = F.col(url_col).cast("string")
    host, path = host_path(url)
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    host, path = F.col("host"), F.col("path")
    key = F.when(host != "", F.concat(host, path))
    marked = cascade.mark(rows, key, "listed")
    return marked.select("page_id", "host", "path",
                         matching_rule(host, path, rules).alias("rule"),
                         F.coalesce(matching_rule(host, path, rules, 2),
                                    F.when(F.col("listed"), F.lit("block"))
                                    .otherwise(F.lit("allow"))).alias("verdict"))
