"""Feature engineering (F1-F7, F16) in SQL-expressible form.

The fitted "processor" is small metadata: per numeric column its min and
max, per categorical column its sorted categories.  Fitting is one
aggregate (min/max) and one distinct per categorical column; applying it is
a projection (literals), so scoring never shuffles.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.config import FILL_AGE, FeatureSpec
from chunkwise.functions import fill_constant


# ------------------------------------------------------------------- F1 F2 F4
def clean_training_frame(df: DataFrame, spec: FeatureSpec, fill_col: str | None = "age",
                         fill_value: float = FILL_AGE) -> DataFrame:
    """Project the spec's columns (S1 order), lower-case categoricals (F2),
    fill ``fill_col`` nulls with a constant (F1), then drop rows with any
    null in the projected columns (F4).  NaN is neither filled nor dropped."""
    cols = [*spec.columns, spec.target]
    extra = [c for c in (spec.id_col, *spec.extra) if c and c in df.columns and c not in cols]
    out = df.select(*extra, *cols)
    out = out.withColumns({c: F.lower(F.col(c)) for c in spec.cat_vars})
    if fill_col is not None and fill_col in cols:
        out = out.withColumn(fill_col, fill_constant(fill_col, fill_value))
    keep = F.lit(True)
    for c in cols:
        keep = keep & F.col(c).isNotNull()
    return out.filter(keep)


# ----------------------------------------------------------------------- F3
def sequential_ids(positioned: DataFrame, pos_col: str = "pos", prefix: str = "person",
                   out_col: str = "person_id") -> DataFrame:
    """``prefix_1 .. prefix_n`` from a 0-based global position (see
    ``operators.positions``)."""
    return positioned.withColumn(out_col, F.concat_ws(
        "_", F.lit(prefix), (F.col(pos_col) + F.lit(1)).cast("string")))


# ----------------------------------------------------------------------- F5
def minmax_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-row frame of ``min_<c>``, ``max_<c>`` (one aggregate pass)."""
    aggs = []
    for c in cols:
        aggs += [F.min(F.col(c).cast("double")).alias(f"min_{c}"),
                 F.max(F.col(c).cast("double")).alias(f"max_{c}")]
    return df.agg(*aggs)


def minmax_expr(c: str | Column, lo: Column, hi: Column) -> Column:
    """``(x - min) / (max - min)``; a constant column divides by 1 (not
    clipped, so unseen values may leave [0, 1])."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    rng = F.when(hi - lo == 0, F.lit(1.0)).otherwise(hi - lo)
    return (x - lo) / rng


def minmax_scale(df: DataFrame, cols: Sequence[str], stats: DataFrame | None = None,
                 prefix: str = "") -> DataFrame:
    """Fit-and-transform in one plan: the 1-row stats frame is broadcast
    (size bound: exactly one row) and applied as arithmetic."""
    stats = stats if stats is not None else minmax_stats(df, cols)
    joined = df.crossJoin(F.broadcast(stats))
    out = joined.withColumns({f"{prefix}{c}": minmax_expr(c, F.col(f"min_{c}"), F.col(f"max_{c}"))
                              for c in cols})
    return out.drop(*[f"{m}_{c}" for c in cols for m in ("min", "max")])


# ----------------------------------------------------------------------- F6
def category_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value): the distinct non-null values of all columns, in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                         F.col(c).cast("string").alias("value")) for c in cols]))
    return df.select(pairs.alias("p")).select("p.*").filter("value IS NOT NULL").distinct()


def fit_categories(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Sorted categories per column, for the dense form only, in which every category is a
    column of the result and so a name the driver holds.  Models encode sparsely instead
    (``operators.model``) and leave the categories to Spark ML."""
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in (category_table(df, cols).collect() if cols else ()):
        out[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in out.items()}


def one_hot_columns(c: str, categories: Sequence[str], prefix: str = "cat_vars__") -> list[Column]:
    """Dense 0/1 columns ``<prefix><c>_<value>``; null and unseen -> all zeros."""
    x = F.col(c).cast("string")
    return [F.when(x == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{prefix}{c}_{v}")
            for v in categories]


# ------------------------------------------------------------------ F7 / F16
@dataclass
class Processor:
    """Fitted feature processor: min/max per numeric column, categories per
    categorical column.  Serialises to JSON next to the model."""

    num_vars: list[str]
    cat_vars: list[str]
    mins: dict[str, float] = field(default_factory=dict)
    maxs: dict[str, float] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, spec: FeatureSpec, with_categories: bool = False
            ) -> "Processor":
        """F16 parity: fit on the frame passed in (the reference fits on all
        rows before the split; pass the train split for ``fit_scope="train"``).
        Categories are left to Spark ML's ``StringIndexer`` unless the dense
        form is asked for (``with_categories``)."""
        num, cat = list(spec.num_vars), list(spec.cat_vars)
        row = minmax_stats(df, num).first() if num else None
        mins = {c: row[f"min_{c}"] for c in num} if row else {}
        maxs = {c: row[f"max_{c}"] for c in num} if row else {}
        cats = fit_categories(df, cat) if with_categories else {c: [] for c in cat}
        return cls(num, cat, mins, maxs, cats)

    def feature_names(self) -> list[str]:
        return ([f"num_vars__{c}" for c in self.num_vars]
                + [f"cat_vars__{c}_{v}" for c in self.cat_vars for v in self.categories[c]])

    def feature_columns(self) -> list[Column]:
        cols = []
        for c in self.num_vars:
            lo, hi = self.mins[c], self.maxs[c]
            if lo is None:
                cols.append(F.lit(None).cast("double").alias(f"num_vars__{c}"))
            else:
                cols.append(minmax_expr(c, F.lit(float(lo)), F.lit(float(hi)))
                            .alias(f"num_vars__{c}"))
        for c in self.cat_vars:
            cols += one_hot_columns(c, self.categories[c])
        return cols

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` columns + named feature columns; everything else dropped."""
        return df.select(*keep, *self.feature_columns())

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "Processor":
        return cls(**json.loads(text))


def feature_matrix(df: DataFrame, spec: FeatureSpec, stats: DataFrame | None = None,
                   categories: dict[str, list[str]] | None = None,
                   keep: Sequence[str] = ()) -> DataFrame:
    """F5+F6+F7 as one lazy plan: scaled numerics ``num_vars__<c>``, one-hot
    ``cat_vars__<c>_<v>``; the target is kept as its own column, never
    scaled into the features."""
    num = list(spec.num_vars)
    cats = categories if categories is not None else fit_categories(df, spec.cat_vars)
    stats = stats if stats is not None else minmax_stats(df, num)
    joined = df.crossJoin(F.broadcast(stats))
    cols = [F.col(k) for k in keep]
    cols += [minmax_expr(c, F.col(f"min_{c}"), F.col(f"max_{c}")).alias(f"num_vars__{c}")
             for c in num]
    for c in spec.cat_vars:
        cols += one_hot_columns(c, cats[c])
    return joined.select(*cols)
