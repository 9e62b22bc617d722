"""Mixing sources to target weights (operator 3).

Every document gets a hash-random key.  Inside a source the keys are cut into equal ranges
(as many as the source's share of the rows asks for, so a hot source is spread over many
tasks); one shuffle sorts each range, word counts are summed within it, and the totals of
the ranges before it, a small table, give the distributed prefix sum.  Each source is cut
at its exact budget; budgets beyond one epoch repeat it.

Keys depend only on the seed and the doc_id and range bounds are arithmetic on them, so a
rerun, or a task recomputed after a lost executor, makes the same choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, stored, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
#: Key ranges per shuffle partition.
RANGES_PER_TASK = 4


def shuffle_key(id_col: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
                 .cast("binary"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, rank, source_size, n_rows, target) from (source, size): ``share`` of all
    words dealt by weight, in code point order of the sources (null last), each target at
    most ``max_epochs`` times its source, the excess dealt again by weight.

    A source is capped when its cap per weight is at most what the rest would get; in the
    order of cap per weight these are the first ones, so one pass over the source table
    settles all rounds of dealing again.
    """
    by_source = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                             F.count(F.lit(1)).alias("n_rows")))
    ranked = by_source.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    dealt = (ranked.withColumn("weight", weight)
             .withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
             .withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everything))
             .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             .withColumn("capped", F.col("cap") * F.sum("weight").over(after)
                         <= F.col("weight") * F.col("left")))
    level = ((F.max("total").over(everything)
              - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything),
                           F.lit(0.0)))
             / F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything))
    return dealt.select("source", "rank", "source_size", "n_rows",
                        F.when(F.col("capped"), F.col("cap"))
                        .otherwise(F.least(F.col("cap"), F.col("weight") * level)).alias("target"))


def _placed(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[int],
            share: float, max_epochs: int, seed: str) -> DataFrame:
    """Every row with its size, its source's rank, size and target, whole ``epochs``, the
    words ``last`` left for a further one, and the words ``before`` it in key order."""
    spark = docs.sparkSession
    sizes = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                               word_count(F.col(text_col).cast("string")).alias("size"),
                               F.col(source_col).cast("string").alias("source")), "mix-sizes")
    targets = stored(source_targets(sizes, weights, share, max_epochs), "mix-targets")
    rows = sizes.count()
    wanted = RANGES_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = F.greatest(F.lit(1), F.ceil(F.col("n_rows") * F.lit(wanted / max(rows, 1)))).cast("long")
    keyed = (sizes.withColumn("key", shuffle_key(F.col("doc_id"), seed))
             .join(targets.withColumnRenamed("source", "_source"),
                   F.col("source").eqNullSafe(F.col("_source")))
             .withColumn("range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
                                          * ranges / F.lit(float(1 << 32))))
             .select("doc_id", "size", "source", "rank", "source_size", "target", "key", "range"))
    starts = (keyed.groupBy("rank", "range").agg(F.sum("size").alias("range_size"))
              .select("rank", "range",
                      F.coalesce(F.sum("range_size").over(
                          Window.partitionBy("rank").orderBy("range")
                          .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start")))
    inside = (Window.partitionBy("rank", "range").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    budget, some = F.floor("target"), F.col("source_size") > 0
    return (keyed.withColumn("upto", F.sum("size").over(inside))
            .join(starts, ["rank", "range"])
            .withColumns({"epochs": F.when(some, F.floor(budget / F.col("source_size")))
                          .otherwise(F.lit(0)).cast("long"),
                          "last": F.when(some, budget % F.col("source_size"))
                          .otherwise(F.lit(0)).cast("long"),
                          "before": F.col("start") + F.col("upto") - F.col("size")}))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: Sequence[int] = WEIGHTS, share: float = SHARE,
        max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs``.

    ``size`` is the number of words (null text: 0).  ``taken`` counts the words the mix
    takes from the row, repeats included: whole epochs of the source, then rows in key
    order until the source's budget (the target, rounded down) is used up; the row at the
    cut gives only its first words.  Rows with the same doc_id are ordered by size.  An
    empty table gives an empty result; null is a source of its own, the last one.
    """
    left = F.col("last") - F.col("before")
    return _placed(docs, id_col, text_col, source_col, weights, share, max_epochs, seed).select(
        "doc_id", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left)))
        .cast("long").alias("taken"))


def source_cuts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: Sequence[int] = WEIGHTS,
                share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """(source, epochs, cut): the whole epochs of each source and, for the last one, the row
    at which its budget ends (key, doc_id, size) with the words still taken from it; null
    if nothing is left for a last epoch."""
    rows = _placed(docs, id_col, text_col, source_col, weights, share, max_epochs, seed)
    ends = (F.col("last") > 0) & (F.col("before") < F.col("last")) & \
        (F.col("before") + F.col("size") >= F.col("last"))
    return rows.groupBy("source").agg(
        F.max("epochs").alias("epochs"),
        F.min(F.when(ends, F.struct("key", "doc_id", "size",
                                    (F.col("last") - F.col("before")).alias("words")))).alias("cut"))


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", seed: str = SEED, **options) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: a row taken twice appears twice,
    the row at its source's cut ends after the last word taken, and rows of which nothing
    is taken are gone.  ``n_chars``, where present, follows the text.  What a row gives
    depends on itself and its source's cut alone, so texts don't shuffle; rows that repeat
    the one at the cut (doc_id and size) are treated like it."""
    names = docs.columns
    cuts = stored(source_cuts(docs, id_col, text_col, source_col, seed=seed, **options), "mix-cuts")
    src, epochs, cut, size, at, part = (fresh(c, names) for c in
                                        ("_source", "_epochs", "_cut", "_size", "_at", "_part"))
    cuts = cuts.select(F.col("source").alias(src), F.col("epochs").alias(epochs),
                       F.col("cut").alias(cut))
    text, own = F.col(text_col).cast("string"), F.col(id_col).cast("long")
    row = F.struct(shuffle_key(own, seed).alias("key"), own.alias("doc_id"),
                   F.col(size).alias("size"))
    stop = F.struct(F.col(cut)["key"].alias("key"), F.col(cut)["doc_id"].alias("doc_id"),
                    F.col(cut)["size"].alias("size"))
    last = (F.when(F.col(cut).isNull(), F.lit(0)).when(F.col(at) < stop, F.col(size))
            .when(F.col(at) == stop, F.col(cut)["words"]).otherwise(F.lit(0)).cast("long"))
    parts = F.concat(F.array_repeat(F.col(size), F.col(epochs).cast("int")), F.array(last))
    first_words = F.expr(  # the first n words, each with the blanks before it
        f"array_join(slice(regexp_extract_all(`{text_col}`, "
        f"'[\\\\x20\\\\x09-\\\\x0D]*[^\\\\x20\\\\x09-\\\\x0D]+', 0), 1, cast({part} as int)), '')")
    out = (docs.withColumn(size, word_count(text)).withColumn(at, row)
           .join(cuts, F.col(source_col).cast("string").eqNullSafe(F.col(src)))
           .withColumn(part, F.explode(F.filter(parts, lambda n: n > 0)))
           .withColumn(text_col, F.when(F.col(part) < F.col(size), first_words).otherwise(text)))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col(part) < F.col(size),
                                               F.length(text_col).cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in names])
