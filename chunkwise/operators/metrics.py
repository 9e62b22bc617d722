"""Exact, tie-aware ROC-AUC (F11) as distributed aggregates.

AUC = (R+ - n+ (n+ + 1) / 2) / (n+ n-), with R+ the sum of the mid-ranks
of the positive rows.  Global ranks come from the positional indexer over
``(group, score, tiebreak)``; a tie group's mid-rank is the mean of its
first and last position, so ties need one ``groupBy(score)`` and no
ordered window over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.operators.positions import with_position


def roc_auc(df: DataFrame, score: str, label: str, id_col: str | None = None,
            group: str | None = None, nulls: str = "raise") -> DataFrame:
    """One row per ``group`` (or one row) with ``n_pos``, ``n_neg``, ``auc``
    (null when a class is missing: AUC is undefined there).  A row without a
    score or a label cannot be ranked: it fails the job, or with
    ``nulls="exclude"`` is left out."""
    unranked = F.col(score).isNull() | F.col(label).isNull()
    if nulls == "exclude":
        df = df.filter(~unranked)
    elif nulls == "raise":
        df = df.filter(F.when(unranked, F.raise_error(F.lit("a row has no score or no label")))
                       .otherwise(F.lit(True)))
    else:
        raise ValueError(f"unknown nulls {nulls!r}")
    keys = [group] if group else []
    base = df.select(
        *keys,
        F.col(score).cast("double").alias("_s"),
        F.col(label).cast("int").alias("_y"),
        (F.col(id_col) if id_col else F.monotonically_increasing_id()).alias("_id"),
    )
    pos = with_position(base, [*keys, "_s", "_id"], "_p")
    # from the checkpointed positions: size, positives and first position, which is the
    # group's start because positions are global over (group, score, id)
    sizes = pos.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                   F.sum("_y").cast("long").alias("n_pos"),
                                   F.min("_p").alias("_start"))
    # ties per (group, score) first: what is joined with the groups is an aggregate
    ties = pos.groupBy(*keys, "_s").agg(
        ((F.min("_p") + F.max("_p")).cast("double") / F.lit(2.0)).alias("_mid"),
        F.sum("_y").cast("long").alias("_pos_in_tie"))
    # mid-rank = mid-position - start + 1, summed over the positives
    sums = ties.groupBy(*keys).agg(F.sum(F.col("_mid") * F.col("_pos_in_tie")).alias("_sum"))
    if group:
        right = sizes.withColumnRenamed(group, "_g")
        joined = sums.join(right, sums[group].eqNullSafe(right["_g"])).drop("_g")
    else:
        joined = sums.crossJoin(sizes)              # one row each
    n_pos, n_neg = F.col("n_pos"), F.col("_n") - F.col("n_pos")
    ranks = F.col("_sum") - (F.col("_start") - F.lit(1)) * n_pos
    return joined.filter("_n > 0").select(
        *keys, "n_pos", n_neg.cast("long").alias("n_neg"),
        F.when((n_pos > 0) & (n_neg > 0),
               (ranks - n_pos.cast("double") * (n_pos + F.lit(1)) / F.lit(2.0))
               / (n_pos.cast("double") * n_neg.cast("double"))).alias("auc"))


def mean_auc(per_group: DataFrame) -> DataFrame:
    """Mean AUC over the groups that produced one (failed folds skipped)."""
    return per_group.agg(F.avg("auc").alias("mean_auc"),
                         F.count("auc").cast("long").alias("n_groups"))
