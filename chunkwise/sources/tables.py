"""Stored tables on plain Parquet.

Plain Parquet has no UPDATE/MERGE: a change reads one path and writes another.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def row_id(key_cols: Sequence[str]) -> Column:
    """Deterministic row id from a business key: md5 of its JSON text, in which nulls and
    separators stay distinct."""
    key = F.struct(*[F.col(c).cast("string").alias(c) for c in key_cols])
    return F.md5(F.to_json(key, {"ignoreNullFields": "false"}))


def with_defaults(df: DataFrame, key_cols: Sequence[str], created_at: Column | None = None,
                  defaults: dict | None = None) -> DataFrame:
    """``df`` with a deterministic ``row_id``, a ``created_at`` (default: now, one moment for
    all rows and every evaluation) and ``defaults`` for columns it lacks, like a table's
    server defaults."""
    out = df.withColumn("row_id", row_id(key_cols))
    if "created_at" not in df.columns:
        now = F.lit(dt.datetime.now(dt.timezone.utc))
        out = out.withColumn("created_at", now if created_at is None else created_at)
    return out.withColumns({c: F.lit(v) for c, v in (defaults or {}).items() if c not in df.columns})


def append_rows(df: DataFrame, path: str, key_cols: Sequence[str],
                created_at: Column | None = None, defaults: dict | None = None) -> DataFrame:
    """Bulk append of ``with_defaults`` rows; returns the appended frame.  A repeated call
    appends again: ``sources.once.append_once`` is the append that a retry can't double."""
    out = with_defaults(df, key_cols, created_at, defaults)
    out.write.mode("append").parquet(path)
    return out


def rewrite_table(spark: SparkSession, src: str, dst: str,
                  change: Callable[[DataFrame], DataFrame],
                  partition_by: Sequence[str] = ()) -> DataFrame:
    """``UPDATE`` / ``DELETE`` / upsert / sweep on plain Parquet: read ``src``, apply
    ``change``, write the result to the new path ``dst`` and return it as read back.
    ``dst`` must not exist, so nothing that was written is ever overwritten; which path is
    current is the caller's to keep."""
    writer = change(spark.read.parquet(src)).write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(dst)
    return spark.read.parquet(dst)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """L1: a table stored by key: ``buckets`` hash buckets of ``key``, sorted inside.  Joins
    and aggregates on the key read it as it lies, without an exchange.  Rows are dealt by the
    key first, so each bucket is one file.  Parquet itself doesn't say how it is bucketed, so
    the table is known to the session's catalog by a name taken from its path."""
    spark, name = df.sparkSession, "t_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex
    (df.repartition(buckets, key).write.mode("errorifexists").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def write_for_lookup(df: DataFrame, path: str, key: str, n_keys: int, false_share: float = 0.01
                     ) -> None:
    """A table for point lookups by ``key``: rows in ranges of the key, sorted, so
    that min/max values rule out all but a row group or two of a key's file, and a Bloom
    filter of the key in every row group, which rules out those that only might hold it.
    ``n_keys``: distinct keys that a row group holds at most (sizes its filter)."""
    (df.repartitionByRange(F.col(key)).sortWithinPartitions(key).write.mode("errorifexists")
     .option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option(f"parquet.bloom.filter.expected.ndv#{key}", str(max(1, n_keys)))
     .option(f"parquet.bloom.filter.fpp#{key}", str(false_share))
     .parquet(path))
