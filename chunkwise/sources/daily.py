"""Changes to a table by partition.

A stored table that is partitioned by day is changed where it must be: only partitions that
hold a matching row are read whole and rewritten (dynamic partition overwrite replaces just
those), partitions whose rows all go are removed without being read, and the files of all
others stay what they are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.operators.ledger import delete_where, update_where
from chunkwise.session import scratch_path
from chunkwise.sources.counted import counting

DAY = "day"
_NULL = "__HIVE_DEFAULT_PARTITION__"


def write_by_day(df: DataFrame, path: str, ts_col: str, mode: str = "errorifexists") -> DataFrame:
    """Write ``df`` partitioned by the date of ``ts_col`` (null: a partition of its own).  The
    rebalance hint gathers a day's rows into few files and splits a day that is too large
    for a task."""
    (df.withColumn(DAY, F.to_date(ts_col)).hint("rebalance", F.col(DAY))
     .write.mode(mode).partitionBy(DAY).parquet(path))
    return df.sparkSession.read.parquet(path)


def _folder(spark: SparkSession, path: str):
    """(Hadoop path, its file system): Spark's own, so any store that Spark writes to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def stored_days(spark: SparkSession, path: str) -> list[dt.date | None]:
    """The days that have a partition, from folder names alone (None: rows without a day)."""
    p, fs = _folder(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    days = [n.split("=", 1)[1] for n in names if n.startswith(f"{DAY}=")]
    return [None if d == _NULL else dt.date.fromisoformat(d) for d in days]


def drop_days(spark: SparkSession, path: str, days: Sequence[dt.date | None]) -> None:
    """Remove whole partitions; nothing is read.  Dropping a missing one does nothing."""
    for day in days:
        p, fs = _folder(spark, f"{path}/{DAY}={_NULL if day is None else day.isoformat()}")
        fs.delete(p, True)


def _on(days: Sequence[dt.date | None]) -> Column:
    dates = [d for d in days if d is not None]
    on = F.col(DAY).isin(dates) if dates else F.lit(False)
    return on | F.col(DAY).isNull() if None in days else on


def change_days(spark: SparkSession, path: str, matching: Column,
                change: Callable[[DataFrame], DataFrame],
                days: Sequence[dt.date | None] | None = None) -> dict:
    """Apply ``change`` to the partitions with a ``matching`` row (or to ``days``) and to no
    others.  Returns the matching rows (counted in the one write) and the days rewritten or
    emptied.

    The new partitions are written beside the table first and then put in its place, so a
    failure before that leaves the table as it was, and repeating the call after a failure
    finishes it; ``change`` must not move rows to other days."""
    table = spark.read.parquet(path)
    if days is None:
        days = [r[DAY] for r in table.filter(matching).select(DAY).distinct().collect()]
    if not days:
        return {"matching": 0, "days": []}
    before, counts = counting(table.filter(_on(days)), matching=matching)
    staged = scratch_path(spark, "changed-days")
    change(before).write.partitionBy(DAY).parquet(staged)
    kept = stored_days(spark, staged)
    if kept:
        (spark.read.schema(table.schema).parquet(staged).hint("rebalance", F.col(DAY))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(DAY).parquet(path))
    drop_days(spark, path, [d for d in days if d not in kept])
    return {"matching": counts()["matching"], "days": sorted(days, key=str)}


def update_days(spark: SparkSession, path: str, predicate: Column,
                assignments: Mapping[str, Column]) -> dict:
    """L4 on a table by day: ``UPDATE .. SET .. WHERE`` that rewrites matching days only."""
    if DAY in assignments:
        raise ValueError("an update can't move rows to another day")
    return change_days(spark, path, predicate, lambda df: update_where(df, predicate, assignments))


def delete_days(spark: SparkSession, path: str, predicate: Column) -> dict:
    """L5 on a table by day: ``DELETE .. WHERE`` that rewrites matching days only."""
    return change_days(spark, path, predicate, lambda df: delete_where(df, predicate))


def sweep_days(spark: SparkSession, path: str, ts_col: str, cutoff: dt.datetime) -> dict:
    """L6 on a table by day: rows with ``ts_col < cutoff`` go (null is kept).  Days before the
    cutoff's are dropped whole; their rows are counted from file footers.  Only the cutoff's
    own day is read, and rewritten if it loses rows."""
    days = stored_days(spark, path)
    old = [d for d in days if d is not None and d < cutoff.date()]
    table = spark.read.parquet(path)
    deleted = table.filter(_on(old)).count() if old else 0
    drop_days(spark, path, old)
    result = {"dropped_days": sorted(old), "deleted": deleted, "days": []}
    if cutoff.date() in days:
        expired = (F.col(ts_col) < F.lit(cutoff).cast(table.schema[ts_col].dataType)) \
            & (F.col(DAY) == F.lit(cutoff.date()))
        spark.catalog.refreshByPath(path)
        edge = change_days(spark, path, expired, lambda df: delete_where(df, expired))
        result.update(deleted=deleted + edge["matching"], days=edge["days"])
    return result
