"""Exact stratified hold-out split and k-fold assignment.

Rows are ranked inside their stratum by ``md5('<seed>:<id>')`` (then id), a
seeded shuffle that any engine can reproduce.  The rank comes from the
global positional indexer over ``(target, hash, id)`` minus the stratum's
start, so no window is partitioned by the (low-cardinality, possibly
skewed) target: one class holding most rows still spreads over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkwise.operators.positions import with_position


def seeded_hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


#: Strata up to this number are broadcast to the rows; more are left to the planner.
MAX_BROADCAST_STRATA = 100_000


def rank_in_stratum(df: DataFrame, target: str, id_col: str, seed: int,
                    rank_col: str = "rank_in_stratum", test_size: float | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """0-based rank of each row inside its stratum; with ``test_size`` also the stratum's
    ``_cw_quota`` of the hold-out.  ``num_partitions``: of the result, instead of as many
    as its bytes ask for."""
    h = "_cw_hash"
    hashed = df.withColumn(h, seeded_hash(id_col, seed))
    pos = with_position(hashed, [target, h, id_col], "_cw_pos", num_partitions)
    # positions are global over (target, ...), so a stratum starts at its
    # smallest position: an aggregate of the checkpointed layout
    strata = pos.groupBy(F.col(target).alias("_cw_t")).agg(
        F.min("_cw_pos").alias("_cw_start"), F.count(F.lit(1)).alias("_cw_n"))
    if test_size is not None:
        strata = holdout_quotas(strata, test_size)
    strata = strata.drop("_cw_n")
    if strata.limit(MAX_BROADCAST_STRATA + 1).count() <= MAX_BROADCAST_STRATA:
        strata = F.broadcast(strata)
    # null-safe: a null target is a stratum of its own, never dropped
    out = pos.join(strata, pos[target].eqNullSafe(strata["_cw_t"])).drop("_cw_t")
    return out.withColumn(rank_col, (F.col("_cw_pos") - F.col("_cw_start")).cast("long")) \
              .drop("_cw_pos", "_cw_start", h)


def holdout_quotas(strata: DataFrame, test_size: float) -> DataFrame:
    """``ceil(n * test_size)`` rows in all, shared over the strata (``_cw_t``, ``_cw_n``) in
    proportion: everyone gets the whole part of its share, the rows left over go to the
    largest remainders (ties in the order of the stratum)."""
    every = Window.partitionBy()
    total = F.sum("_cw_n").over(every)
    draws = F.ceil(total.cast("double") * F.lit(float(test_size)))
    product = "cast(_cw_n as decimal(19,0)) * cast(_cw_draws as decimal(19,0))"
    share = strata.withColumns({"_cw_draws": draws, "_cw_total": total}).withColumns({
        "_cw_whole": F.expr(f"({product}) div _cw_total"),
        "_cw_rest": F.expr(f"cast(({product}) % _cw_total as bigint)")})
    place = F.row_number().over(Window.orderBy(F.desc("_cw_rest"), "_cw_t"))
    left = F.col("_cw_draws") - F.sum("_cw_whole").over(every)
    return share.withColumn("_cw_quota", F.col("_cw_whole") + (place <= left).cast("long")) \
                .drop("_cw_draws", "_cw_total", "_cw_whole", "_cw_rest")


def hash_unit(id_col: str, seed: int) -> Column:
    """A deterministic value in [0, 1) from ``md5('<seed>:<id>')`` (32 bits)."""
    h = F.substring(seeded_hash(id_col, seed), 1, 8)
    return F.conv(h, 16, 10).cast("double") / F.lit(4294967296.0)


def hash_split(df: DataFrame, id_col: str, test_size: float = 0.2, seed: int = 42,
               split_col: str = "split") -> DataFrame:
    """A row is ``test`` when its seeded hash falls below ``test_size``: one pass, no
    shuffle, not stratified (each class gets its share in expectation only)."""
    return df.withColumn(split_col, F.when(hash_unit(id_col, seed) < F.lit(float(test_size)),
                                           F.lit("test")).otherwise(F.lit("train")))


def stratified_split(df: DataFrame, target: str, id_col: str, test_size: float = 0.2,
                     seed: int = 42, split_col: str = "split",
                     num_partitions: int | None = None) -> DataFrame:
    """F8: ``ceil(n * test_size)`` rows go to ``test``, shared over the strata in proportion
    (``holdout_quotas``), in each stratum the first ones of the seeded order; the rest to
    ``train``."""
    ranked = rank_in_stratum(df, target, id_col, seed, test_size=test_size,
                             num_partitions=num_partitions)
    return ranked.withColumn(split_col, F.when(F.col("rank_in_stratum") < F.col("_cw_quota"),
                                               F.lit("test")).otherwise(F.lit("train"))) \
                 .drop("rank_in_stratum", "_cw_quota")


def stratified_folds(df: DataFrame, target: str, id_col: str, n_splits: int = 5,
                     seed: int = 42, fold_col: str = "fold",
                     num_partitions: int | None = None) -> DataFrame:
    """``fold = rank_in_stratum % n_splits`` (balanced within each class)."""
    ranked = rank_in_stratum(df, target, id_col, seed, num_partitions=num_partitions)
    return ranked.withColumn(fold_col, (F.col("rank_in_stratum") % F.lit(n_splits)).cast("int")) \
                 .drop("rank_in_stratum")
