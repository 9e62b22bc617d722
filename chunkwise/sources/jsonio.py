"""JSON record files.

JSON Lines is the scale format.  A file that holds one JSON array is read by
many tasks as well (``jsonarray``), at the price of a shuffle of its text;
writing a single array file would funnel the job through one task, so only
lines are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwise.sources.jsonarray import array_elements

_TS_NTZ_FMT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_json_records(spark: SparkSession, path: str, schema: T.StructType,
                      array_file: bool = False, corrupt_col: str | None = None) -> DataFrame:
    """Declared schema, never inferred.  A malformed record fails the read;
    with ``corrupt_col`` it is kept with its raw text for quarantine instead.  The elements
    of an array file are its records, in no particular order."""
    if array_file:
        options = {"mode": "FAILFAST", "timestampNTZFormat": _TS_NTZ_FMT}
        fields = [f.name for f in schema.fields]
        if corrupt_col:
            schema = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
            options.update(mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt_col)
            fields.append(corrupt_col)
        rows = array_elements(spark, path).select(F.from_json("raw", schema, options).alias("_r"))
        return rows.select(*[F.col("_r")[f].alias(f) for f in fields])
    reader = spark.read.schema(schema).option("mode", "FAILFAST") \
                  .option("timestampNTZFormat", _TS_NTZ_FMT)
    if corrupt_col:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
        reader = spark.read.schema(schema).option("mode", "PERMISSIVE") \
                      .option("columnNameOfCorruptRecord", corrupt_col) \
                      .option("timestampNTZFormat", _TS_NTZ_FMT)
    return reader.json(path)


def read_json_objects(spark: SparkSession, path: str, array_file: bool = False,
                      out_col: str = "record", typed: bool = False) -> DataFrame:
    """JSON objects as ``MAP<STRING,STRING>`` (``typed``: ``MAP<STRING,
    VARIANT>``, keeping each value's JSON token type) with key presence kept
    per record (``record``); a malformed object gives a null ``record`` so it
    can be quarantined, with its text in ``raw``.  An array file also gives each
    element's ``item_index``."""
    value = T.VariantType() if typed else T.StringType()
    obj = T.MapType(T.StringType(), value)
    if array_file:
        return array_elements(spark, path).select(
            "item_index", F.from_json(F.col("raw"), obj).alias(out_col), "raw")
    text = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    return text.select(F.from_json(F.col("value"), obj).alias(out_col),
                       F.col("value").alias("raw"))


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """S3: one JSON object per line, written by every task in parallel."""
    df.write.mode(mode).option("timestampNTZFormat", _TS_NTZ_FMT) \
      .option("ignoreNullFields", "false").json(path)
    return path
