"""Fixed-size chunking and job roll-ups.

A chunk is a logical slice ``chunk_id = position // size`` of the input in a
declared order; Spark's physical partitions stay independent of it.  Chunk
results are aggregated with shuffle aggregates (map-side partials), never by
collecting a chunk or a job into one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.config import API_CHUNK_SIZE, PROGRESS_EVERY, SAMPLE_ROWS
from chunkwise.functions.numeric import round_python
from chunkwise.operators.positions import with_position, with_position_and_total


def assign_chunks(df: DataFrame, order_by: Sequence[str | Column],
                  size: int = API_CHUNK_SIZE, num_partitions: int | None = None) -> DataFrame:
    """A1: add ``pos`` (0-based), ``chunk_id``, ``item_index`` (position in
    the chunk) and ``total_items``.  The last chunk may be short; an empty
    input yields no rows and so no chunks.  Project ``df`` first: the
    positions are checkpointed, which stops column pruning below."""
    if size <= 0:
        raise ValueError("chunk size must be positive")
    out = with_position_and_total(df, order_by, "pos", "total_items", num_partitions)
    return (out.withColumn("chunk_id", F.floor(F.col("pos") / F.lit(size)).cast("long"))
               .withColumn("item_index", (F.col("pos") % F.lit(size)).cast("long")))


def chunk_size_col(size: int) -> Column:
    """Items in the row's chunk: full chunks hold ``size``, the last the rest."""
    return F.least(F.lit(size).cast("long"),
                   F.col("total_items") - F.col("chunk_id") * F.lit(size)).cast("long")


def dispatch_summary(df: DataFrame, size: int = API_CHUNK_SIZE) -> DataFrame:
    """A2: ``{status: dispatched, total_items, chunks = ceil(n / size)}``."""
    n = F.count(F.lit(1)).cast("long")
    return df.agg(
        F.lit("dispatched").alias("status"),
        n.alias("total_items"),
        F.floor((n + F.lit(size - 1)) / F.lit(size)).cast("long").alias("chunks"),
    )


def prechunked_explode(df: DataFrame, chunks_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """A3: a list of lists -> one row per item with ``chunk_id`` (outer index)
    and ``item_index`` (inner index)."""
    outer = df.select(*keep, F.posexplode(chunks_col).alias("chunk_id", "_chunk"))
    return outer.select(*keep, F.col("chunk_id").cast("long").alias("chunk_id"),
                        F.posexplode("_chunk").alias("item_index", "item")) \
                .withColumn("item_index", F.col("item_index").cast("long"))


def chunk_stats(chunked: DataFrame, duration: str | Column | None = None,
                keys: Sequence[str] = ("chunk_id",)) -> DataFrame:
    """A4: ``{chunk_id, item_count, processing_time}`` per chunk.  Time is a
    data column (e.g. a measured duration); wall-clock lives in Spark metrics."""
    dur = F.lit(0.0) if duration is None else (
        F.col(duration) if isinstance(duration, str) else duration)
    return chunked.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("long").alias("item_count"),
        F.sum(dur.cast("double")).alias("processing_time"),
    )


def combine_chunks(stats: DataFrame, digits: int = 2) -> DataFrame:
    """A5: sum of item counts, number of chunks and the *unweighted* mean of
    chunk times rounded to ``digits``; 0.0 for an empty job."""
    return stats.agg(
        F.lit("completed").alias("status"),
        F.count(F.lit(1)).cast("long").alias("total_chunks"),
        F.coalesce(F.sum("item_count"), F.lit(0)).cast("long").alias("total_items"),
        F.coalesce(round_python(F.avg("processing_time"), digits), F.lit(0.0))
         .alias("avg_processing_time"),
    )


def concat_ordered(*parts: DataFrame) -> DataFrame:
    """UNION ALL of chunk outputs with the job order as ``seq``, the position in
    (chunk_id, item_index): chunks of any length follow one another without gaps."""
    unioned = reduce(lambda a, b: a.unionByName(b), parts)
    return with_position(unioned, ["chunk_id", "item_index"], "seq")


def sample_head(df: DataFrame, n: int = SAMPLE_ROWS,
                order_by: Sequence[str] = ("chunk_id", "item_index")) -> DataFrame:
    """First ``n`` rows in job order (TakeOrderedAndProject, top-k)."""
    return df.orderBy(*order_by).limit(n)


def job_log(stats: DataFrame, sample: DataFrame, job_name: str, sample_col: str,
            completed_at: Column | None = None,
            order_by: Sequence[str] = ("chunk_id", "item_index")) -> DataFrame:
    """One job row.  ``input_data`` / ``output_data`` hold counts and a
    bounded sample of ``sample_col`` values in job order, never the payload."""
    combined = combine_chunks(stats)
    sample = sample_head(sample, order_by=order_by)      # bounded whatever the caller passes
    ordered = F.struct(*[F.col(c) for c in order_by], F.col(sample_col).alias("v"))
    samp = sample.agg(F.sort_array(F.collect_list(ordered)).alias("_s")) \
                 .select(F.transform("_s", lambda s: s["v"]).alias("_sample"))
    row = combined.crossJoin(samp)
    return row.select(
        F.lit(job_name).alias("job_name"),
        F.to_json(F.struct(F.col("total_chunks").alias("chunks"), F.col("total_items")),
                  {"ignoreNullFields": "false"}).alias("input_data"),
        F.to_json(F.struct(F.col("total_items"), F.col("_sample").alias("sample")),
                  {"ignoreNullFields": "false"}).alias("output_data"),
        F.col("avg_processing_time").alias("processing_time"),
        F.lit("completed").alias("status"),
        (completed_at if completed_at is not None else F.current_timestamp())
        .alias("completed_at"),
    )


def progress_points(chunked: DataFrame, size: int = API_CHUNK_SIZE,
                    throttled: bool = False, every: int = PROGRESS_EVERY,
                    stats: DataFrame | None = None) -> DataFrame:
    """Progress records ``{current, total, chunk_id}`` per item; with
    ``throttled`` only every ``every``-th item and the last of each chunk, plus
    ``percentage = round(current / total * 100, 1)``.  Needs ``assign_chunks``
    output, whose chunk totals are arithmetic on the job total; chunks of other
    sizes take theirs from ``stats`` (``chunk_stats``)."""
    cur = (F.col("item_index") + F.lit(1)).cast("long")
    tot = chunk_size_col(size)
    if stats is not None:
        chunked = chunked.join(stats.select("chunk_id", F.col("item_count").alias("_n")), "chunk_id")
        tot = F.col("_n")
    out = chunked.select("chunk_id", "item_index", cur.alias("current"), tot.alias("total"))
    if not throttled:
        return out.drop("item_index")
    keep = ((F.col("item_index") % F.lit(every)) == 0) | (F.col("current") == F.col("total"))
    return out.filter(keep).select(
        "chunk_id", "current", "total",
        round_python(F.col("current").cast("double") / F.col("total") * F.lit(100.0), 1)
         .alias("percentage"))


def label_rows(df: DataFrame, run_id: str, id_col: str, text_col: str,
               entities: Column, label: Column, score: Column) -> DataFrame:
    """A10: project ``(id, run_id, text, entities, label, score)``."""
    return df.select(F.col(id_col).alias("id"), F.lit(run_id).alias("run_id"),
                     F.col(text_col).alias("text"), entities.alias("entities"),
                     label.alias("label"), score.cast("double").alias("score"))


def map_reduce_sum(df: DataFrame, value: str) -> DataFrame:
    """Map ``x -> x + x`` over the group, then reduce with a sum."""
    doubled = (F.col(value) + F.col(value)).cast("long")
    return df.select(doubled.alias("_v")).agg(
        F.coalesce(F.sum("_v"), F.lit(0)).cast("long").alias("total"),
        F.count(F.lit(1)).cast("long").alias("n_tasks"))


def chain(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Sequential stages; each step's output feeds the next (one plan)."""
    return reduce(lambda acc, step: acc.transform(step), steps, df)
