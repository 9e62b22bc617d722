"""Declarative validation for the ledger record kinds (V4, V5, V7, V9).

A ``RecordSpec`` lists fields with a Spark type, whether they are required,
a default for absent fields, an allowed set and a length bound.  The
validator is the same single projection as for persons: typed values plus an
``errors`` array, split by ``operators.validate.split_valid``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise import config
from chunkwise.functions import coercible, errors_column, max_length, one_of, required
from chunkwise.operators.validate import ERRORS, alias_columns, apply_defaults, fields_from_map


@dataclass(frozen=True)
class FieldSpec:
    name: str
    dtype: str = "string"                 # Spark SQL type name
    required: bool = False
    default: object = None                # applied when the field is absent
    allowed: tuple[str, ...] = ()
    max_len: int | None = None
    default_now: bool = False             # absent -> the ``now`` column


@dataclass(frozen=True)
class RecordSpec:
    name: str
    fields: tuple[FieldSpec, ...] = field(default_factory=tuple)


# Record kinds of the ledger tables (fixed values from the record contract).
EMAIL_SPEC = RecordSpec("email", (
    FieldSpec("recipient", required=True, max_len=config.LENGTH_BOUNDS["recipient"]),
    FieldSpec("subject", required=True, max_len=config.LENGTH_BOUNDS["subject"]),
    FieldSpec("body", required=True),
    FieldSpec("status", default="processing", allowed=config.EMAIL_STATUS,
              max_len=config.LENGTH_BOUNDS["status"]),
    FieldSpec("created_at", "timestamp", default_now=True),
    FieldSpec("sent_at", "timestamp"),
))
JOB_SPEC = RecordSpec("job", (
    FieldSpec("job_name", required=True, max_len=config.LENGTH_BOUNDS["job_name"]),
    FieldSpec("input_data", required=True),
    FieldSpec("output_data", required=True),
    FieldSpec("processing_time", "double", required=True),
    FieldSpec("status", default="pending", allowed=config.JOB_STATUS),
    FieldSpec("created_at", "timestamp", default_now=True),
    FieldSpec("completed_at", "timestamp"),
))
TASK_EVENT_SPEC = RecordSpec("task_event", (
    FieldSpec("task_id", required=True),
    FieldSpec("task_name"),
    FieldSpec("status", default="PENDING", allowed=config.TASK_STATUS_ALL),
    FieldSpec("updated_at", "timestamp"),
    FieldSpec("args"), FieldSpec("kwargs"), FieldSpec("result"), FieldSpec("error"),
))


def _typed(raw: Column, dtype: str) -> Column:
    return raw if dtype == "string" else raw.try_cast(dtype)


def validate_records(raw: DataFrame, spec: RecordSpec, now: Column | None = None,
                     keep: Sequence[str] | None = None, map_col: str | None = None
                     ) -> DataFrame:
    """Typed fields of ``spec`` plus ``errors``.  Fields are read under
    camelCase or snake_case names, from columns or from a JSON-object map
    (``map_col``, presence per record); defaults apply to absent fields only."""
    now = now if now is not None else F.current_timestamp()
    names = [f.name for f in spec.fields]
    if map_col is not None:
        carry = list(keep or [])
        shaped = fields_from_map(raw, map_col, names, carry)
    else:
        from chunkwise.functions import camel_case
        spelled = set(names) | {camel_case(n) for n in names}
        carry = list(keep) if keep is not None else [c for c in raw.columns if c not in spelled]
        shaped = alias_columns(raw, names, carry, fill_absent=False)
    shaped = apply_defaults(shaped, {f.name: f.default for f in spec.fields
                                     if f.default is not None})
    shaped = shaped.withColumns({f.name: F.lit(None).cast("string") for f in spec.fields
                                 if f.name not in shaped.columns})
    values, rules = {}, []
    for f in spec.fields:
        rawc = F.col(f.name)
        val = _typed(rawc, f.dtype)
        if f.default_now:
            val = F.when(F.col(f"_present_{f.name}"), val).otherwise(now)
        values[f.name] = val
        if f.required:
            rules.append(required(f.name, rawc))
        if f.dtype != "string":
            rules.append(coercible(f.name, rawc, _typed(rawc, f.dtype)))
        if f.allowed:
            rules.append(one_of(f.name, f.allowed, rawc))
        if f.max_len:
            rules.append(max_length(f.name, f.max_len, rawc))
    return shaped.select(*carry, *[v.alias(k) for k, v in values.items()],
                         errors_column(rules).alias(ERRORS))
