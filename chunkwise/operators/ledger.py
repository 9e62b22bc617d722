"""Task, e-mail and job ledgers.

The task ledger is a *fold* over task events: for every field the value of
the latest event that carries it, "latest" being the ordering key
``struct(updated_at, event_seq)``.  Each ledger row keeps the ordering key
of every field, so merging new events into a stored ledger is the same fold
over ``ledger UNION events``: the fold is associative and commutative, and a
streamed ledger equals the batch ledger whatever the arrival order.

Hot task ids are safe: ``max_by`` has a partial (map-side) phase, so a task
with a third of all events is reduced inside every map task before the
shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise import config
from chunkwise.functions import not_like
from chunkwise.sources.tables import row_id

LATEST_FIELDS = ("status", "updated_at", "task_name", "args", "kwargs")
NONNULL_FIELDS = ("result", "error", "traceback")
LEDGER_COLUMNS = ("task_id", "task_name", "status", "updated_at", "args", "kwargs",
                  "result", "error", "traceback")


def _ord_name(f: str) -> str:
    return f"_ord_{f}"


def events_to_ledger_input(events: DataFrame, seq_col: str = "event_seq") -> DataFrame:
    """Attach per-field ordering keys to raw task events
    (``task_id, task_name, status, updated_at, args, kwargs, result, error`` and, where
    the source has it, ``traceback``)."""
    if "traceback" not in events.columns:
        events = events.withColumn("traceback", F.lit(None).cast("string"))
    key = F.struct(F.col("updated_at").alias("ts"), F.col(seq_col).cast("long").alias("seq"))
    cols = [F.col(c) for c in LEDGER_COLUMNS]
    cols += [key.alias(_ord_name("latest"))]
    cols += [F.when(F.col(f).isNotNull(), key).alias(_ord_name(f)) for f in NONNULL_FIELDS]
    return events.select(*cols)


def _fold(inputs: DataFrame) -> DataFrame:
    latest = F.col(_ord_name("latest"))
    aggs = [F.max_by(F.col(f), latest).alias(f) for f in LATEST_FIELDS]
    aggs += [F.max_by(F.col(f), F.col(_ord_name(f))).alias(f) for f in NONNULL_FIELDS]
    aggs += [F.max(latest).alias(_ord_name("latest"))]
    aggs += [F.max(F.col(_ord_name(f))).alias(_ord_name(f)) for f in NONNULL_FIELDS]
    folded = inputs.groupBy("task_id").agg(*aggs)
    return folded.select(*LEDGER_COLUMNS, _ord_name("latest"),
                         *[_ord_name(f) for f in NONNULL_FIELDS])


def fold_task_ledger(events: DataFrame, seq_col: str = "event_seq") -> DataFrame:
    """L1: one row per ``task_id``: status/updated_at/name/args/kwargs of the
    latest event; result/error of the latest event that set them (an error
    survives a later SUCCESS).  Hidden ``_ord_*`` columns allow merges."""
    return _fold(events_to_ledger_input(events, seq_col))


def merge_task_ledger(ledger: DataFrame, events: DataFrame, seq_col: str = "event_seq"
                      ) -> DataFrame:
    """L1 upsert: fold(stored ledger UNION new events)."""
    stored = ledger.select(*LEDGER_COLUMNS, _ord_name("latest"),
                           *[_ord_name(f) for f in NONNULL_FIELDS])
    return _fold(stored.unionByName(events_to_ledger_input(events, seq_col)))


def upsert_by_key(stored: DataFrame, delta: DataFrame) -> DataFrame:
    """L1 upsert of a folded ``delta`` (one row a task, as ``fold_task_ledger`` gives) into a
    stored ledger as a join by task: a ledger bucketed by ``task_id`` stays where it lies and
    only the delta is shuffled.  Field by field, the later ordering key wins, as in the fold."""
    def side(df: DataFrame, mark: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{mark}{c}") for c in
                           (*LEDGER_COLUMNS, _ord_name("latest"),
                            *[_ord_name(f) for f in NONNULL_FIELDS])])

    old, new = side(stored, "o_"), side(delta, "n_")
    both = old.join(new, F.col("o_task_id") == F.col("n_task_id"), "full_outer")

    def later(order: str) -> Column:
        a, b = F.col(f"o_{order}"), F.col(f"n_{order}")
        return b.isNotNull() & (a.isNull() | (b > a))

    def pick(field: str, order: str) -> Column:
        return F.when(later(order), F.col(f"n_{field}")).otherwise(F.col(f"o_{field}"))

    latest = _ord_name("latest")
    values = {f: pick(f, latest) for f in (*LATEST_FIELDS, latest)}
    for f in NONNULL_FIELDS:
        values[f], values[_ord_name(f)] = pick(f, _ord_name(f)), pick(_ord_name(f), _ord_name(f))
    values["task_id"] = F.coalesce("o_task_id", "n_task_id")
    return both.select(*[values[c].alias(c) for c in
                         (*LEDGER_COLUMNS, latest, *[_ord_name(f) for f in NONNULL_FIELDS])])


def fold_ledger_rows(rows: DataFrame) -> DataFrame:
    """Fold frames that are in ledger form already (a stored ledger, the deltas of a stream)."""
    return _fold(rows)


def public_ledger(ledger: DataFrame) -> DataFrame:
    return ledger.select(*LEDGER_COLUMNS)


# ----------------------------------------------------------------------- L8
def latest_progress(points: DataFrame, task_col: str = "task_id",
                    order: Column | None = None) -> DataFrame:
    """Latest progress point per task (``current, total, chunk_id``), as a
    partial-aggregating ``max_by``; ``order`` defaults to ``current``."""
    key = order if order is not None else F.col("current")
    return points.groupBy(task_col).agg(*[
        F.max_by(F.col(c), key).alias(c) for c in ("current", "total", "chunk_id")])


def task_status_lookup(requests: DataFrame, ledger: DataFrame, id_col: str = "task_id",
                       progress: DataFrame | None = None) -> DataFrame:
    """Status of requested ids: unknown ids read as PENDING (left join).
    With ``progress`` (one row per task, see ``latest_progress``) a task that
    has reported progress and has not finished reads as PROGRESS with its
    ``current``/``total``/``chunk_id``.  Joins are planned by Catalyst/AQE:
    every side may be large."""
    led = ledger.select(F.col("task_id").alias("_lid"), "status", "result", "error",
                        "traceback")
    j = requests.join(led, requests[id_col] == led["_lid"], "left")
    status = F.col("status")
    if progress is not None:
        prog = progress.select(F.col("task_id").alias("_pid"), F.col("current").alias("_pc"),
                               F.col("total").alias("_pt"), F.col("chunk_id"))
        j = j.join(prog, requests[id_col] == prog["_pid"], "left")
        done = F.coalesce(status.isin("SUCCESS", "FAILURE", "RETRY", "REVOKED"), F.lit(False))
        status = F.when(~done & F.col("_pid").isNotNull(), F.lit("PROGRESS")).otherwise(status)
    state = F.coalesce(status, F.lit("PENDING"))
    msg = F.lit(None).cast("string")
    for s, text in reversed(list(config.STATUS_MESSAGES.items())):
        msg = F.when(state == F.lit(s), F.lit(text)).otherwise(msg)
    return j.select(
        requests[id_col].alias(id_col),
        state.alias("state"),
        state.isin(*config.READY_STATES).alias("ready"),
        msg.alias("message"),
        *([F.when(state == "PENDING", F.lit(0)).when(state == "PROGRESS", F.col("_pc"))
           .cast("int").alias("current"),
           F.when(state == "PENDING", F.lit(1)).when(state == "PROGRESS", F.col("_pt"))
           .cast("int").alias("total"),
           F.when(state == "PROGRESS", F.col("chunk_id")).cast("long").alias("chunk_id")]
          if progress is not None else
          [F.when(state == "PENDING", F.lit(0)).cast("int").alias("current"),
           F.when(state == "PENDING", F.lit(1)).cast("int").alias("total")]),
        F.when(state == "SUCCESS", F.col("result")).alias("result"),
        F.when(state.isin("FAILURE", "RETRY"), F.col("error")).alias("error"),
        F.when(state == "FAILURE", F.col("traceback")).alias("traceback"),
        F.when(state == "SUCCESS", F.lit(True)).when(state == "FAILURE", F.lit(False))
         .alias("successful"),
        F.when(state.isin("RETRY", "REVOKED"), F.lit(0)).cast("int").alias("percentage"),
    )


# ----------------------------------------------------------------------- L2
def email_lifecycle(mails: DataFrame, deliveries: DataFrame, key: str,
                    delivered_at: str = "sent_at") -> DataFrame:
    """Mails start ``processing``; a delivery sets ``sent_at`` and
    ``success``.  ``deliveries`` must hold at most one row per key (aggregate
    first: a hot key is then one row, not a third of the join)."""
    d = deliveries.select(F.col(key).alias("_dk"), F.col(delivered_at).alias("_sent"))
    j = mails.join(d, mails[key] == d["_dk"], "left")
    delivered = F.col("_sent").isNotNull()
    return j.select(*[mails[c] for c in mails.columns if c not in ("status", "sent_at")],
                    F.when(delivered, F.lit("success")).otherwise(
                        F.coalesce(mails["status"] if "status" in mails.columns else F.lit(None),
                                   F.lit("processing"))).alias("status"),
                    F.col("_sent").alias("sent_at"))


# ----------------------------------------------------------------------- L3
def bulk_dispatch(mails: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """One send task per mail with a deterministic id (``row_id`` of the key), plus
    ``total_emails`` (a one-row aggregate, broadcast)."""
    tid = row_id(key_cols)
    total = mails.agg(F.count(F.lit(1)).cast("long").alias("total_emails"))
    return mails.withColumn("task_id", tid).withColumn("status", F.lit("dispatched")) \
                .crossJoin(F.broadcast(total))


# ------------------------------------------------------------------ L4 L5
def update_where(df: DataFrame, predicate: Column, assignments: Mapping[str, Column]
                 ) -> DataFrame:
    """``UPDATE t SET c = v WHERE p``: rows where ``p`` is null are untouched."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in assignments.items()})


def delete_where(df: DataFrame, predicate: Column, null_in: Sequence[str] = ()) -> DataFrame:
    """``DELETE FROM t WHERE p``: rows where ``p`` is null are kept.  If ``p`` is null
    exactly where one of the columns ``null_in`` is (comparisons with literals), naming
    them lets the predicate reach the scan."""
    unknown = [F.col(c).isNull() for c in null_in] or [predicate.isNull()]
    return df.filter(reduce(Column.__or__, unknown, ~predicate))


# ----------------------------------------------------------------------- L6
def retention_cutoff(as_of: Column, days: int = config.RETENTION_DAYS,
                     seconds: int | None = None) -> Column:
    """``as_of - days`` (the 30-day sweep) or ``as_of - seconds`` (the
    one-hour result TTL: ``seconds=3600``)."""
    if seconds is not None:
        return as_of - F.expr(f"INTERVAL {int(seconds)} SECONDS")
    return as_of - F.expr(f"INTERVAL {int(days)} DAYS")


def retained(df: DataFrame, ts_col: str, cutoff: Column) -> DataFrame:
    """Survivors of a sweep: ``created < cutoff`` (strict) is deleted, null kept."""
    return df.filter((F.col(ts_col) >= cutoff) | F.col(ts_col).isNull())


def retention_counts(tables: Mapping[str, tuple], cutoff: Column | None = None) -> DataFrame:
    """One row per table: rows deleted and kept, from one conditional
    aggregate per table (the count and the delete share the predicate).
    ``tables`` maps a name to ``(df, ts_col)`` (shared ``cutoff``) or to
    ``(df, ts_col, cutoff)`` for a table on its own clock."""
    rows = []
    for name, spec in tables.items():
        df, ts_col = spec[0], spec[1]
        table_cutoff = spec[2] if len(spec) > 2 else cutoff
        if table_cutoff is None:
            raise ValueError(f"{name}: no cutoff")
        cutoff_col = table_cutoff
        old = F.coalesce(F.col(ts_col) < cutoff_col, F.lit(False))
        rows.append(df.agg(F.lit(name).alias("table_name"),
                           F.count_if(old).cast("long").alias("deleted"),
                           F.count_if(~old).cast("long").alias("kept")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


# ----------------------------------------------------------------------- L7
def health_stats(tasks: DataFrame, task_name_col: str, emails: DataFrame, email_ts_col: str,
                 jobs: DataFrame, job_status_col: str, as_of: Column,
                 pattern: str = config.HEALTH_TASK_PATTERN,
                 hours: int = config.HEALTH_WINDOW_HOURS, pending: str = "pending"
                 ) -> DataFrame:
    """Three counts in one row: tasks whose name is NOT LIKE the pattern
    (null names excluded), e-mails newer than ``as_of - hours``, jobs whose
    status is ``pending``.  Three one-row aggregates, cross-joined."""
    def rows(df: DataFrame, condition: Column, name: str) -> DataFrame:
        return df.filter(condition).agg(F.count(F.lit(1)).cast("long").alias(name))

    since = as_of - F.expr(f"INTERVAL {int(hours)} HOURS")
    t = rows(tasks, not_like(task_name_col, pattern), "total_tasks")
    e = rows(emails, F.col(email_ts_col) > since, "recent_emails_24h")
    j = rows(jobs, F.col(job_status_col) == F.lit(pending), "active_processing_jobs")
    return t.crossJoin(e).crossJoin(j)


# ----------------------------------------------------------------------- L9
def unique_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias("n_rows")) \
             .filter(F.col("n_rows") > 1)


# ---------------------------------------------------------------------- L10
def created_before(df: DataFrame, ts_col: str, as_of: Column) -> DataFrame:
    """``created_at < as_of`` (pushed to the Parquet scan)."""
    return df.filter(F.col(ts_col) < as_of)
