"""Numeric helpers (Column -> Column, JVM-side)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkwise.config import FILL_AGE, THRESHOLD


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_python(c: str | Column, digits: int = 2) -> Column:
    """Python's ``round(x, digits)`` for doubles, exactly, as Column arithmetic.

    Python rounds the *binary* value half-even (2.675 -> 2.67, 0.125 -> 0.12);
    Spark's ``round`` rounds the decimal text half-up (2.68, 0.13).  With
    s = 10**digits, Dekker's error-free product gives ``x * s = p + err``
    exactly in double arithmetic.  The result differs from ``rint(p)`` only
    near a half: where ``p`` is halfway the sign of ``err`` decides (an exact
    tie stays half-even), and where ``p`` is integral an ``err`` of one half is
    the tie.  Once neighbouring doubles lie further apart than the rounding
    step, the double nearest to the rounded value is x itself.  ``digits`` up
    to 6."""
    if not 0 <= digits <= 6:
        raise ValueError("digits must be in 0..6")
    s = F.lit(float(10 ** digits))
    # smallest power of two from which doubles are spaced wider than 10**-digits
    limit = 2.0 ** (52 + math.ceil(math.log2(10.0 ** -digits)))
    x = _col(c).cast("double")
    t = F.lit(134217729.0) * x                      # 2**27 + 1: split x = xh + xl
    xh = t - (t - x)
    xl = x - xh
    p = x * s
    err = (xh * s - p) + xl * s                     # exact remainder of x * s
    tie = (p - F.floor(p)) == F.lit(0.5)
    even = F.pmod(p, F.lit(2.0)) == F.lit(0.0)
    n = (F.when(tie & (err > 0), F.ceil(p).cast("double"))
          .when(tie & (err < 0), F.floor(p).cast("double"))
          .when(~tie & (F.abs(err) == F.lit(0.5)), F.when(even, p).otherwise(p + err * F.lit(2.0)))
          .otherwise(F.rint(p)))
    finite = ~F.isnan(x) & (F.abs(x) < F.lit(limit))
    return F.when(finite, n / s).otherwise(x)


def round2(c: str | Column, digits: int = 2, mode: str = "python") -> Column:
    """Two-decimal rounding (V3).  ``mode="python"`` (default) reproduces
    Python's ``round`` exactly (see ``round_python``); ``mode="half_up"`` is
    Spark's / SQL's ``round`` on the decimal text."""
    if mode == "python":
        return round_python(c, digits)
    if mode == "half_up":
        return F.round(_col(c).cast("double"), digits)
    raise ValueError(f"unknown rounding mode {mode!r}")


#: Decimal numbers as text; integers as text, a zero fraction allowed.
_NUMBER = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
_INTEGER = r"^\s*([+-]?\d+)(\.0*)?\s*$"


def _is_number(c: Column) -> Column:
    """Is the column of a fractional numeric type?  Decided when the query is analysed."""
    return F.typeof(c).isin("double", "float") | F.typeof(c).startswith("decimal")


def lax_double(c: str | Column) -> Column:
    """Lax number parsing: numbers pass, numeric text parses, junk ('12d', '1 2') -> null."""
    x = _col(c)
    text = x.try_cast("string")
    return F.when(_is_number(x) | text.rlike(_NUMBER), x.try_cast("double"))


def lax_int(c: str | Column) -> Column:
    """Lax integer parsing (V6) to BIGINT: integers and numbers or text without a fraction
    (2, 2.0, '2', '2.0') pass; fractions, other text ('12d', '1e3') and values beyond
    BIGINT become null."""
    x = _col(c)
    d = x.try_cast("double")
    text = F.nullif(F.regexp_extract(x.try_cast("string"), _INTEGER, 1), F.lit(""))
    return F.when(_is_number(x), F.when(d == F.rint(d), x.try_cast("decimal(38,0)").try_cast("bigint"))) \
            .otherwise(text.try_cast("bigint"))


def fill_constant(c: str | Column, value: float = FILL_AGE) -> Column:
    """Null -> constant (F1).  NaN is left alone, unlike ``na.fill``."""
    return F.coalesce(_col(c), F.lit(float(value)))


def threshold_label(p: str | Column, threshold: float = THRESHOLD) -> Column:
    """Strict ``p > threshold`` on the unrounded probability, as BIGINT."""
    return (_col(p) > F.lit(float(threshold))).cast("bigint")
