"""Counts taken inside a write.

``DataFrame.observe`` computes aggregates over the rows that flow through a plan, while they
are written: no second scan, and the counts are those of what was written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def counting(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df``, and a function that gives the number of its rows for which each condition
    holds, once an action has run over the returned frame (it waits for the first one; only
    that one counts).  Rows that a caller filters out of the returned frame are counted."""
    seen = Observation()
    named = {k: F.count_if(F.coalesce(c, F.lit(False))).cast("long").alias(k)
             for k, c in conditions.items()}
    observed = df.observe(seen, *named.values())
    return observed, lambda: {k: int(seen.get[k] or 0) for k in named}
