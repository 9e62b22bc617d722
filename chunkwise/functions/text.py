"""String and serialisation helpers (Column -> Column, JVM-side)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwise.config import TEXT_LOG_LIMIT

# Leading/trailing whitespace, Unicode-aware like Python's str.strip().
_EDGE_BLANKS = r"(?U)^\s+|\s+$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_blanks(c: str | Column) -> Column:
    """``str.strip()``: remove leading and trailing whitespace of any kind.

    ``F.trim`` only removes the space character, so a regex is used.
    """
    return F.regexp_replace(_col(c), _EDGE_BLANKS, "")


def norm_category(c: str | Column) -> Column:
    """``value.lower().strip()`` applied before an enumeration check (V2)."""
    return strip_blanks(F.lower(_col(c)))


def upper_strings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Upper-case every string column; other columns pass unchanged."""
    wanted = set(columns) if columns is not None else None
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType) and (wanted is None or f.name in wanted):
            out.append(F.upper(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def truncate_text(c: str | Column, limit: int = TEXT_LOG_LIMIT) -> Column:
    """``str(x)[:limit]`` in characters."""
    return F.substring(_col(c).cast("string"), 1, limit)


def not_like(c: str | Column, pattern: str) -> Column:
    """``NOT LIKE`` with SQL null semantics: a null value does not match."""
    return ~_col(c).like(pattern)


def iso_timestamp(c: str | Column) -> Column:
    """Python ``datetime.isoformat()``: microseconds shown only when non-zero."""
    full = F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(full, r"\.000000$", "")


def json_scalar(c: str | Column) -> Column:
    """``json.dumps(value)`` of a scalar: strings gain quotes, null is ``null``.

    Serialises a one-element array and strips the brackets, so escaping is
    Spark's JSON writer (non-ASCII characters stay UTF-8).
    """
    arr = F.to_json(F.array(_col(c)))
    return arr.substr(F.lit(2), F.length(arr) - 2)


def serialize_value(c: str | Column, data_type: T.DataType) -> Column:
    """Timestamps to ISO text, everything else to JSON text."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return iso_timestamp(c)
    return json_scalar(c)


def camel_case(name: str) -> str:
    """``snake_case`` -> ``camelCase`` (first word lower-case)."""
    head, *rest = name.split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest)


def snake_case(name: str) -> str:
    """``camelCase`` -> ``snake_case``."""
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()
