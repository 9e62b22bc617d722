"""Global row positions without a single-partition window.

``row_number() OVER (ORDER BY k)`` plans ``Exchange SinglePartition``: every
row goes through one task.  Instead:

1. range-partition on the (unique) order key into P partitions and sort
   inside each partition;
2. record the partition id and the row's index inside its partition
   (``monotonically_increasing_id`` minus the partition id shifted by 33
   bits is exactly that index);
3. checkpoint this layout into the shared checkpoint folder, so both passes
   below read the same partitions even after executor loss (range bounds
   are sampled, so recomputing the shuffle could move rows);
4. count rows per partition (P rows), turn the counts into offsets with a
   window over those P rows, and broadcast-join the offsets back.  The
   broadcast side has at most P rows, a bound fixed by construction.

Position = offset(partition) + index in partition.  The checkpoint is a
barrier to column pruning: project ``df`` to the columns needed downstream
before calling.  A skewed *value* of
the order key cannot overload a task: a row id is appended as tiebreaker, so
the range partitioner can split any hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkwise.session import ensure_checkpoint_dir

PID = "_cw_pid"
LOCAL = "_cw_local"


def _order_cols(order_by: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def range_layout(df: DataFrame, order_by: Sequence[str | Column],
                 num_partitions: int | None = None, tiebreak: bool = True) -> DataFrame:
    """Range-partitioned, locally sorted, checkpointed copy of ``df`` with
    ``_cw_pid`` and ``_cw_local`` columns.

    With ``tiebreak`` a row id is appended to the order, so even a
    non-unique key whose hot value holds a large share of the rows is split
    across range partitions (ties are then in input order; the checkpoint
    freezes that order)."""
    ensure_checkpoint_dir(df.sparkSession)
    order = _order_cols(order_by)
    if tiebreak:
        df = df.withColumn("_cw_tb", F.monotonically_increasing_id())
        order = [*order, F.col("_cw_tb")]
    # Without an explicit count the range exchange is sized by AQE: adjacent
    # ranges are coalesced towards the advisory partition size, so P follows
    # the data (<= spark.sql.shuffle.partitions) and the order is kept.
    parted = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    layout = (
        parted
        .sortWithinPartitions(*order)
        .withColumn(PID, F.spark_partition_id())
        .withColumn(LOCAL, F.monotonically_increasing_id()
                    - F.shiftleft(F.col(PID).cast("long"), 33))
    )
    return layout.checkpoint(eager=True)


def partition_offsets(layout: DataFrame) -> DataFrame:
    """(``_cw_pid``, ``_cw_off``, ``_cw_n``, ``_cw_total``) for each range
    partition: at most P rows, so the window below runs over P rows only."""
    counts = layout.groupBy(PID).agg(F.count(F.lit(1)).alias("_cw_n"))
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding,
                                            Window.unboundedFollowing)
    return counts.select(
        PID,
        F.coalesce(F.sum("_cw_n").over(before), F.lit(0)).cast("long").alias("_cw_off"),
        F.col("_cw_n"),
        F.sum("_cw_n").over(every).cast("long").alias("_cw_total"),
    )


def with_position(df: DataFrame, order_by: Sequence[str | Column], pos_col: str = "pos",
                  num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based global position in the total order ``order_by``.

    Ties (a non-unique order) are broken by input order, frozen by the
    checkpoint.
    """
    layout = range_layout(df, order_by, num_partitions)
    offsets = partition_offsets(layout).select(PID, "_cw_off")
    joined = layout.join(F.broadcast(offsets), PID)
    return joined.select(*[F.col(c) for c in df.columns],
                         (F.col("_cw_off") + F.col(LOCAL)).cast("long").alias(pos_col))


def with_position_and_total(df: DataFrame, order_by: Sequence[str | Column],
                            pos_col: str = "pos", total_col: str = "total",
                            num_partitions: int | None = None) -> DataFrame:
    """``with_position`` plus the total row count as a column: the total
    travels in the same ≤ P-row offsets table, so still one broadcast join."""
    layout = range_layout(df, order_by, num_partitions)
    offs = partition_offsets(layout).select(PID, "_cw_off", "_cw_total")
    joined = layout.join(F.broadcast(offs), PID)
    return joined.select(*[F.col(c) for c in df.columns],
                         (F.col("_cw_off") + F.col(LOCAL)).cast("long").alias(pos_col),
                         F.col("_cw_total").alias(total_col))
