"""Declared schemas of the record contract (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

PERSON = T.StructType([
    T.StructField("person_id", T.StringType(), True),
    T.StructField("sex", T.StringType(), True),
    T.StructField("age", T.DoubleType(), True),
    T.StructField("pclass", T.IntegerType(), True),
    T.StructField("sibsp", T.IntegerType(), True),
    T.StructField("parch", T.IntegerType(), True),
    T.StructField("fare", T.DoubleType(), True),
    T.StructField("embarked", T.StringType(), True),
    T.StructField("survived", T.IntegerType(), True),
    T.StructField("created_at", T.TimestampType(), True),
])

# Raw person as it arrives in JSON: every field a string so that lax
# coercion and "absent vs null" can be decided by the validator.
PERSON_RAW_FIELDS = ["person_id", "personId", "sex", "age", "pclass", "sibsp", "parch",
                     "fare", "embarked", "survived", "created_at", "createdAt"]
PERSON_RAW = T.StructType([T.StructField(f, T.StringType(), True) for f in PERSON_RAW_FIELDS])

PERSONS_ENVELOPE = T.StructType([T.StructField("persons", T.ArrayType(PERSON_RAW), True)])
DATA_ENVELOPE = T.StructType([T.StructField("data", T.ArrayType(PERSON_RAW), True)])

# A JSON object as a string map keeps *key presence* per record: an absent
# key is not in the map, an explicit JSON null is a present key with a null
# value.  Numbers keep their JSON text and are coerced by the validator.
RECORD_MAP = T.MapType(T.StringType(), T.StringType(), True)
PERSONS_ENVELOPE_KEYS = T.StructType([T.StructField("persons", T.ArrayType(RECORD_MAP), True)])
DATA_ENVELOPE_KEYS = T.StructType([T.StructField("data", T.ArrayType(RECORD_MAP), True)])

# Same with VARIANT values: the JSON token type survives per field, so a
# quoted number (STRING) can be told from a JSON number (DECIMAL / DOUBLE).
RECORD_VARIANT_MAP = T.MapType(T.StringType(), T.VariantType(), True)
PERSONS_ENVELOPE_TYPED = T.StructType([
    T.StructField("persons", T.ArrayType(RECORD_VARIANT_MAP), True)])
DATA_ENVELOPE_TYPED = T.StructType([T.StructField("data", T.ArrayType(RECORD_VARIANT_MAP), True)])

PRED_OUTPUT = T.StructType([
    T.StructField("person_id", T.StringType(), True),
    T.StructField("survived", T.IntegerType(), True),
    T.StructField("probability", T.DoubleType(), True),
])

PREDICTION = T.StructType([
    T.StructField("data", PRED_OUTPUT, True),
    T.StructField("status", T.StringType(), False),
    T.StructField("created_at", T.TimestampType(), True),
])

EMAIL = T.StructType([
    T.StructField("recipient", T.StringType(), False),
    T.StructField("subject", T.StringType(), False),
    T.StructField("body", T.StringType(), False),
    T.StructField("status", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("sent_at", T.TimestampType(), True),
])

JOB = T.StructType([
    T.StructField("job_name", T.StringType(), False),
    T.StructField("input_data", T.StringType(), True),
    T.StructField("output_data", T.StringType(), True),
    T.StructField("processing_time", T.DoubleType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("completed_at", T.TimestampType(), True),
])

TASK_EVENT = T.StructType([
    T.StructField("task_id", T.StringType(), False),
    T.StructField("task_name", T.StringType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("updated_at", T.TimestampType(), True),
    T.StructField("args", T.StringType(), True),
    T.StructField("kwargs", T.StringType(), True),
    T.StructField("result", T.StringType(), True),
    T.StructField("error", T.StringType(), True),
])

# Event message sent when a job completes.
EVENT_HEADERS = T.MapType(T.StringType(), T.StringType())
