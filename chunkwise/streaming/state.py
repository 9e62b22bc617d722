"""Streams with keyed state: de-duplication of redelivered messages (T4) and the callback
that fires when a run's last chunk is in (A5, S7).

State lives in RocksDB on the executors, off the heap, with its changes in the stream's
checkpoint in the shared folder: a micro-batch costs what its own keys cost, however long
the stream has run, and a restart or a lost executor continues from the last commit.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor

from chunkwise.session import ship_package

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"


@contextmanager
def rocksdb_state(spark: SparkSession, idle_batches: bool = True):
    """Queries started inside keep their state in RocksDB (a query that restarts from a
    checkpoint keeps the store it began with), and run batches without new data or not."""
    wanted = {_PROVIDER: _ROCKSDB} | ({} if idle_batches else {_IDLE: "false"})
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


# --------------------------------------------------------------------------- T4
def dedupe_stream(stream: DataFrame, key: str, event_time: str | None = None,
                  within: str | None = None) -> DataFrame:
    """The first copy of each ``key`` (null is one key); later copies, in whatever
    micro-batch they come, are recognised by the key's state and dropped.  No row is dropped
    for being late, and nothing already written is read again.

    The state holds one entry per key for good.  Where redelivery has a known bound, name the
    event time and the bound (``within="3 days"``): keys older than the watermark are then
    forgotten, and so are rows that come later than that."""
    if within is None:
        return stream.dropDuplicates([key])
    if event_time is None:
        raise ValueError("within needs event_time")
    return stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark([key])


# --------------------------------------------------------------------- A5 and S7
#: Of a run: chunks seen and their sums; the bits of the chunk ids seen; reported as done.
_STATE = ("total_chunks long, seen long, items long, millis long, chunks binary, done boolean, "
          "overdue boolean")
COMBINED = ("run_id string, status string, total_chunks long, total_items long, "
            "avg_processing_time double")


class CombineRuns(StatefulProcessor):
    """Keyed state of a run's chunk results (``chunk_id``, ``total_chunks``, ``item_count``,
    ``millis``): when the last distinct chunk is in, in any order and however often chunks are
    delivered again, one ``completed`` row is emitted.  A run not complete ``overdue_ms``
    after it was first heard of gives one ``overdue`` row with what is in (and still its
    ``completed`` row, should the rest come).  A finished run keeps a mark of a few bytes for
    ``forget_ms``, so late copies of its chunks fire nothing."""

    def __init__(self, overdue_ms: int, forget_ms: int, digits: int = 2):
        self.overdue_ms, self.forget_ms, self.digits = overdue_ms, forget_ms, digits

    def init(self, handle) -> None:
        self.handle, self.run = handle, handle.getValueState("run", _STATE)

    def _row(self, key: tuple, status: str, seen: int, items: int, millis: int) -> pd.DataFrame:
        mean = round(millis / 1000 / seen, self.digits) if seen else 0.0
        return pd.DataFrame([(key[0], status, seen, items, mean)],
                            columns=["run_id", "status", "total_chunks", "total_items",
                                     "avg_processing_time"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.run.get()
        if state is None:
            total, seen, items, millis, bits, done, overdue = 0, 0, 0, 0, b"", False, False
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.overdue_ms)
        else:
            total, seen, items, millis, bits, done, overdue = state
        if done:
            return
        have = np.unpackbits(np.frombuffer(bits, np.uint8))
        for part in rows:       # Arrow batches of bounded size
            part = part.drop_duplicates("chunk_id")
            total = max(total, int(part["total_chunks"].max()))
            if total > len(have):
                have = np.concatenate([have, np.zeros(-(-total // 8) * 8 - len(have), np.uint8)])
            ids = part["chunk_id"].to_numpy()
            fresh = (ids >= 0) & (ids < total)      # an id outside the run's range is no chunk
            fresh[fresh] = have[ids[fresh]] == 0
            have[ids[fresh]] = 1
            seen += int(fresh.sum())
            items += int(part["item_count"].to_numpy()[fresh].sum())
            millis += int(part["millis"].to_numpy()[fresh].sum())
        if seen == total:
            self.run.update((total, seen, 0, 0, b"", True, overdue))
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.forget_ms)
            yield self._row(key, "completed", seen, items, millis)
        else:
            self.run.update((total, seen, items, millis, np.packbits(have).tobytes(), False, overdue))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self.run.get()
        if state is None:
            return
        total, seen, items, millis, bits, done, overdue = state
        if done:
            # a run has two timers, in either order: the later one forgets it
            if not any(t > expiredTimerInfo.getExpiryTimeInMs() for t in self.handle.listTimers()):
                self.run.clear()
        elif not overdue:
            self.run.update((total, seen, items, millis, bits, done, True))
            yield self._row(key, "overdue", seen, items, millis)

    def close(self) -> None:
        pass


def combine_runs(chunk_results: DataFrame, overdue_s: float = 7200, forget_s: float = 86400
                 ) -> DataFrame:
    """The job row of each run (``run_id, status, total_chunks, total_items,
    avg_processing_time``: the unweighted mean of the chunk times, in seconds to two
    decimals) as soon as all its chunks are in.  ``chunk_results`` is a stream of ``run_id``,
    ``chunk_id`` (from 0), ``total_chunks``, ``item_count`` and ``millis``; rows without one
    of them are not results and are left out.  A run's state is a bit for each chunk, and
    results are one row a chunk, so even a run that holds most of the stream stays small."""
    cols = ["chunk_id", "total_chunks", "item_count", "millis"]
    rows = chunk_results.selectExpr("cast(run_id as string) run_id",
                                    *[f"cast({c} as long) {c}" for c in cols])
    ship_package(chunk_results.sparkSession)
    rows = rows.dropna(subset=["run_id", *cols]).filter("total_chunks > 0")
    return rows.groupBy("run_id").transformWithStateInPandas(
        CombineRuns(int(overdue_s * 1000), int(forget_s * 1000)), COMBINED, "Append",
        "ProcessingTime")
