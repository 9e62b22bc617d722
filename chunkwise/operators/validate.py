"""Record validation, quarantine and record shaping.

Validation is one projection: every rule becomes a ``CASE`` inside an
``errors`` array, so a chunk of any size is validated in a single pass in
whole-stage codegen.  Rows are split on ``size(errors) = 0``; nothing is
dropped without being kept in the rejected output.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwise import config
from chunkwise.schemas import PERSON
from chunkwise.sources.counted import counting
from chunkwise.functions import (Rule, camel_case, coercible, errors_column, lax_double,
                                 lax_int, max_length, norm_category, one_of, required, round2,
                                 serialize_value)

ERRORS = "errors"


# --------------------------------------------------------------------------- V1
def alias_columns(df: DataFrame, fields: Sequence[str], keep: Sequence[str] = (),
                  aliases: Mapping[str, Sequence[str]] | None = None,
                  fill_absent: bool = True) -> DataFrame:
    """Accept each field under its camelCase alias or its snake_case name;
    columns not listed in ``fields`` or ``keep`` are dropped.  When both
    spellings are present the alias wins where it is non-null.  A
    ``_present_<f>`` flag records whether the field exists at all, so
    defaults can tell an absent field from an explicit null; with
    ``fill_absent=False`` an absent field gets no column at all."""
    cols = set(df.columns)
    out = [F.col(k) for k in keep]
    for f in fields:
        names = [camel_case(f), f]
        if aliases and f in aliases:
            names = [*aliases[f], *names]
        present = [n for n in dict.fromkeys(names) if n in cols]
        if not present:
            if fill_absent:
                out.append(F.lit(None).cast("string").alias(f))
            out.append(F.lit(False).alias(f"_present_{f}"))
        else:
            value = F.col(present[0]) if len(present) == 1 else F.coalesce(
                *[F.col(n) for n in present])
            out += [value.alias(f), F.lit(True).alias(f"_present_{f}")]
    return df.select(*out)


def fields_from_map(df: DataFrame, map_col: str, fields: Sequence[str],
                    keep: Sequence[str] = ()) -> DataFrame:
    """V1 for JSON objects parsed as ``MAP<STRING,STRING>`` or
    ``MAP<STRING,VARIANT>``: each field under its camelCase alias or
    snake_case name, with *per-record* presence (an absent key and an
    explicit null differ, so defaults apply correctly).  For VARIANT values a
    ``_kind_<f>`` column keeps the JSON token type (STRING, DECIMAL(p,s), ...)."""
    m = F.col(map_col)
    typed = isinstance(df.schema[map_col].dataType.valueType, T.VariantType)
    out = [F.col(k) for k in keep]
    for f in fields:
        names = list(dict.fromkeys([camel_case(f), f]))
        present = F.lit(False)
        for n in names:
            present = present | F.map_contains_key(m, F.lit(n))
        raw = F.coalesce(*[m.getItem(n) for n in names]) if len(names) > 1 else m.getItem(f)
        if typed:
            # text of the value plus its JSON token type (STRING, DECIMAL(p,s), ...)
            out += [F.variant_get(raw, "$", "string").alias(f),
                    F.when(~F.is_variant_null(raw), F.schema_of_variant(raw))
                     .alias(f"_kind_{f}")]
        else:
            out.append(raw.alias(f))
        out.append(present.alias(f"_present_{f}"))
    return df.select(*out)


def drop_presence(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_present_")])


# --------------------------------------------------------------------------- V5
def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Defaults apply to *absent* fields only (column missing, or the
    ``_present_`` flag false); an explicit null stays null and is judged by
    the rules."""
    for f, v in defaults.items():
        lit = F.lit(v)
        flag = f"_present_{f}"
        if f not in df.columns:
            df = df.withColumn(f, lit)
        elif flag in df.columns:
            df = df.withColumn(f, F.when(F.col(flag), F.col(f)).otherwise(lit.cast(
                df.schema[f].dataType)))
    return df


# ----------------------------------------------------------------------- V2-V9
def person_rules_and_values(df: DataFrame, now: Column | None = None
                            ) -> tuple[dict[str, Column], list]:
    """Typed values and rules of a person record (fields as raw columns)."""
    now = now if now is not None else F.current_timestamp()
    kinds = {c[len("_kind_"):]: F.col(c) for c in df.columns if c.startswith("_kind_")}
    sex = norm_category(F.col("sex").cast("string"))
    emb = norm_category(F.col("embarked").cast("string"))
    age_d, fare_d = lax_double(F.col("age")), lax_double(F.col("fare"))

    def two_dp(name: str, v: Column) -> Column:
        # the reference rounds only values that arrive as numbers; a quoted
        # number is coerced unrounded (token types known for typed JSON only)
        if name in kinds:
            return F.when(kinds[name] == "STRING", v).otherwise(round2(v))
        return round2(v)
    ints = {c: lax_int(F.col(c)) for c in ("pclass", "sibsp", "parch", "survived")}
    created_raw = F.col("created_at")
    created = created_raw.try_cast("timestamp") if not isinstance(
        df.schema["created_at"].dataType, T.TimestampType) else created_raw
    values = {
        "person_id": F.col("person_id").cast("string"),
        "sex": sex,
        "age": two_dp("age", age_d),
        "pclass": ints["pclass"],
        "sibsp": ints["sibsp"],
        "parch": ints["parch"],
        "fare": two_dp("fare", fare_d),
        "embarked": emb,
        "survived": ints["survived"],
        "created_at": F.coalesce(created, now) if "_present_created_at" not in df.columns
        else F.when(F.col("_present_created_at"), created).otherwise(now),
    }
    rules = [
        required("sex", F.col("sex")), one_of("sex", config.SEX_VALUES, sex),
        required("age", F.col("age")), coercible("age", F.col("age"), age_d),
        required("fare", F.col("fare")), coercible("fare", F.col("fare"), fare_d),
        required("embarked", F.col("embarked")),
        one_of("embarked", config.EMBARKED_VALUES, emb),
        required("survived", F.col("survived")),
        coercible("survived", F.col("survived"), ints["survived"]),
        max_length("person_id", config.LENGTH_BOUNDS["person_id"], F.col("person_id")),
        coercible("created_at", created_raw, created),
    ]
    for c in ("pclass", "sibsp", "parch"):
        rules += [required(c, F.col(c)), coercible(c, F.col(c), ints[c])]
    for c in ("person_id", "sex", "embarked"):
        if c in kinds:   # string fields: a JSON number or boolean is not coerced
            rules.append(Rule(f"{c}: must be a string",
                              kinds[c].isNotNull() & (kinds[c] != "STRING")))
    return values, rules


def validate_persons(raw: DataFrame, now: Column | None = None,
                     keep: Sequence[str] | None = None, map_col: str | None = None
                     ) -> DataFrame:
    """V1+V2+V3+V4+V5+V6+V9 on raw person records: typed person columns plus
    ``errors``.  Records are either columns (presence per column) or, with
    ``map_col``, JSON objects as maps (presence per record; with VARIANT
    values only JSON numbers are rounded and string fields must be strings).  ``keep``
    columns (default: every other column) are carried through untouched."""
    fields = [f.name for f in PERSON]
    spelled = set(fields) | {camel_case(f) for f in fields} | {map_col}
    carry = list(keep) if keep is not None else [c for c in raw.columns if c not in spelled]
    if map_col is not None:
        shaped = fields_from_map(raw, map_col, fields, carry)
    else:
        shaped = alias_columns(raw, fields, carry, fill_absent=False)
    shaped = apply_defaults(shaped, config.PERSON_DEFAULTS)
    shaped = shaped.withColumns({f: F.lit(None).cast("string") for f in fields
                                 if f not in shaped.columns})
    values, rules = person_rules_and_values(shaped, now)
    return shaped.select(*carry, *[v.alias(k) for k, v in values.items()],
                         errors_column(rules).alias(ERRORS))


def with_errors(df: DataFrame, rules: Iterable) -> DataFrame:
    """Attach ``errors`` for arbitrary rules (generic V7 front-end)."""
    return df.withColumn(ERRORS, errors_column(rules))


# --------------------------------------------------------------------------- V7
def split_valid(df: DataFrame, mode: str = "quarantine", chunk_col: str = "chunk_id"
                ) -> tuple[DataFrame, DataFrame]:
    """Split on ``errors``.

    * ``quarantine``: valid rows vs rows with at least one error.
    * ``fail_chunk``: one bad row rejects its whole chunk (as the reference's
      chunk task does); bad chunk ids are aggregated and anti/semi-joined.
      The bad-chunk list is not broadcast by force: AQE decides on its size.
    * ``fail_job``: evaluation raises on the first bad row (a filter guard,
      so no extra pass; filters a caller adds afterwards may be pushed to the
      scan first, and rows they exclude are then not checked).
    """
    bad = F.size(F.col(ERRORS)) > 0
    if mode == "quarantine":
        return df.filter(~bad), df.filter(bad)
    if mode == "fail_chunk":
        if chunk_col not in df.columns:
            raise ValueError(f"mode='fail_chunk' needs a {chunk_col!r} column: assign "
                             "chunks (operators.chunks.assign_chunks) before validating")
        bad_chunks = df.filter(bad).select(chunk_col).distinct()
        return (df.join(bad_chunks, chunk_col, "left_anti"),
                df.join(bad_chunks, chunk_col, "left_semi"))
    if mode == "fail_job":
        # the check is a filter predicate, so column pruning cannot drop it
        # (a raise_error inside a projected column would vanish as soon as a
        # caller selects other columns)
        guard = F.when(bad, F.raise_error(F.concat(
            F.lit("validation failed: "), F.array_join(F.col(ERRORS), "; ")))
        ).otherwise(F.lit(True))
        return df.filter(guard), df.limit(0)
    raise ValueError(f"unknown mode {mode!r}")


def write_split_counted(df: DataFrame, path: str, mode: str = "overwrite"
                        ) -> tuple[dict[str, str], dict[str, int]]:
    """Write valid and rejected rows in one pass (one scan, one write):
    ``<path>/outcome=valid`` and ``<path>/outcome=rejected``; their numbers are observed in
    the write.  Two filtered writes would read and validate the input twice, and counts
    afterwards read the output again."""
    good = F.size(F.col(ERRORS)) == 0
    counted, counts = counting(df, valid=good, rejected=~good)
    outcome = F.when(good, F.lit("valid")).otherwise(F.lit("rejected"))
    counted.withColumn("outcome", outcome).write.mode(mode).partitionBy("outcome").parquet(path)
    return {o: f"{path}/outcome={o}" for o in ("valid", "rejected")}, counts()


def write_split(df: DataFrame, path: str, mode: str = "overwrite") -> dict[str, str]:
    """``write_split_counted`` for callers that need the paths only."""
    return write_split_counted(df, path, mode)[0]


# --------------------------------------------------------------------------- V8
def explode_envelope(df: DataFrame, body_col: str, schema: T.StructType, key: str = "data",
                     first_only: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """``{data: [...]}`` -> one row per element with ``item_index``; with
    ``first_only`` only element 0 is kept (the single-record endpoint).  A
    body that does not decode (or lacks the list) yields one row with a null
    ``item``, which validation rejects; an empty list yields no rows."""
    parsed = df.select(*keep, F.from_json(F.col(body_col), schema).alias("_env"))
    elem = schema[key].dataType.elementType
    got = F.col("_env").getField(key)
    arr = F.when(got.isNull(), F.array(F.lit(None).cast(elem))).otherwise(got)
    if first_only:
        return parsed.filter(F.size(arr) > 0).select(
            *keep, F.lit(0).cast("long").alias("item_index"), F.get(arr, 0).alias("item"))
    return parsed.select(*keep, F.posexplode(arr).alias("item_index", "item")) \
                 .withColumn("item_index", F.col("item_index").cast("long"))


# -------------------------------------------------------------------------- V10
def serialize_fields(df: DataFrame, fields: Sequence[str] = (
        "created_at", "completed_at", "updated_at", "args", "kwargs", "result", "error")
                     ) -> DataFrame:
    """Timestamps -> ISO text, everything else -> JSON text, for the listed
    fields that exist (``sent_at`` is deliberately not covered)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[serialize_value(c, types[c]).alias(c) if c in fields else F.col(c)
                       for c in df.columns])


# -------------------------------------------------------------------------- V11
def to_camel_output(df: DataFrame) -> DataFrame:
    """``model_dump(by_alias=True)``: every column renamed to camelCase."""
    return df.withColumnsRenamed({c: camel_case(c) for c in df.columns if camel_case(c) != c})


# -------------------------------------------------------------------------- V12
def prediction_struct(df: DataFrame, created_at: Column | None = None,
                      status: str = "success") -> DataFrame:
    """Keep ``person_id, survived, probability (2 dp)`` wrapped as
    ``{data, status, created_at}``; other columns are dropped."""
    return df.select(
        F.struct(F.col("person_id").cast("string").alias("person_id"),
                 F.col("survived").cast("int").alias("survived"),
                 round2(F.col("probability")).alias("probability")).alias("data"),
        F.lit(status).alias("status"),
        (created_at if created_at is not None else F.current_timestamp()).alias("created_at"),
    )


# -------------------------------------------------------------------------- V13
def dead_letter_log(df: DataFrame, body_col: str, completed_at: Column | None = None
                    ) -> DataFrame:
    """Message-shape dispatch of dead letters: a ``persons`` key means a batch
    of ``len(persons)`` items, otherwise a single record; one job row each."""
    persons = F.get_json_object(F.col(body_col), "$.persons")
    is_batch = persons.isNotNull()
    mtype = F.when(is_batch, F.lit("batch")).otherwise(F.lit("single"))
    count = F.when(is_batch, F.json_array_length(persons)).otherwise(F.lit(1)).cast("long")
    return df.select(
        "*",
        mtype.alias("message_type"),
        count.alias("item_count"),
    ).select(
        "*",
        F.concat(F.lit("dlq_"), F.col("message_type"), F.lit("_processing")).alias("job_name"),
        F.col(body_col).alias("input_data"),
        F.to_json(F.struct(F.lit("dlq_processed").alias("status"),
                           F.col("message_type"))).alias("output_data"),
        F.lit(0.0).alias("processing_time"),
        F.lit(0).cast("long").alias("prediction_count"),
        F.lit("dlq_processed").alias("status"),
        (completed_at if completed_at is not None else F.current_timestamp())
        .alias("completed_at"),
    )
