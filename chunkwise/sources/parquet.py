"""Parquet scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, empty if there is no such path; any other failure is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_project(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Read Parquet keeping ``columns`` in that order.  A missing column
    is an analysis error; only the listed columns reach ``ReadSchema``."""
    return spark.read.parquet(path).select(*columns)


def select_where(df: DataFrame, predicate: Column | None = None, **equals: object) -> DataFrame:
    """Rows matching all ``column == value`` pairs (AND) and an optional
    extra predicate; pushed down to the scan by Catalyst."""
    cond = F.lit(True) if predicate is None else predicate
    for c, v in equals.items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.filter(cond)


class CardinalityError(ValueError):
    pass


def scalar_one(df: DataFrame, allow_none: bool = False) -> DataFrame:
    """``scalar_one()`` / ``scalar_one_or_none()``.  At most two rows are
    fetched to check the cardinality; the checked frame is returned."""
    n = df.limit(2).count()
    if n > 1:
        raise CardinalityError("multiple rows were found when exactly one was required")
    if n == 0 and not allow_none:
        raise CardinalityError("no row was found when one was required")
    return df.limit(1)
