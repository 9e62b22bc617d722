"""Declarative validation rules.

A rule is a name plus a Column that is TRUE when a row breaks it.  All rules
of a record are evaluated in one projection into an ``errors ARRAY<STRING>``
so validation is a single pass inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    broken: Column          # TRUE when the row breaks the rule (null = not broken)

    def message(self) -> Column:
        return F.when(F.coalesce(self.broken, F.lit(False)), F.lit(self.name))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def required(c: str, value: Column | None = None) -> Rule:
    """Field must be present and non-null (V5)."""
    v = value if value is not None else F.col(c)
    return Rule(f"{c}: required", v.isNull())


def one_of(c: str, allowed: Sequence[str], value: Column | None = None) -> Rule:
    """Value must be in the allowed set; null counts as not allowed (V4)."""
    v = value if value is not None else F.col(c)
    ok = F.coalesce(v.isin(list(allowed)), F.lit(False))
    return Rule(f"{c}: must be one of {','.join(allowed)}", ~ok)


def max_length(c: str, n: int, value: Column | None = None) -> Rule:
    """String length bound of the stored column (V9); null passes."""
    v = value if value is not None else F.col(c)
    return Rule(f"{c}: longer than {n}", F.length(v) > F.lit(n))


def coercible(c: str, raw: Column, parsed: Column) -> Rule:
    """A non-null raw value that did not parse (V6)."""
    return Rule(f"{c}: invalid value", raw.isNotNull() & parsed.isNull())


def errors_column(rules: Iterable[Rule]) -> Column:
    """``ARRAY<STRING>`` of the names of the broken rules (empty if valid)."""
    msgs = [r.message() for r in rules]
    if not msgs:
        return F.array().cast("array<string>")
    return F.filter(F.array(*msgs), lambda x: x.isNotNull())
