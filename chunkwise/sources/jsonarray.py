"""One JSON array per file, read by many tasks.

Spark's text reader splits a file at any delimiter, so the array is read in fragments that
end at ``}``, as many tasks as the file has splits.  Where a fragment lies (inside a string?
how many objects deep?) depends on all text before it, so that is settled by two running
sums: every split is summed up for both cases (it begins outside or inside a string), the
small table of splits is run through in file order, and each split then knows how it begins.

Objects that are one fragment, all flat ones, are complete there; fragments of nested
objects, or of strings that hold ``}``, are gathered by the object's number.  Only Spark's
readers touch the file, in whatever store it lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Stand-ins (control characters, which JSON text can't hold) for an escaped backslash, an
# escaped quote, and structural characters inside strings.
_BACKSLASH, _QUOTE = "\x01", "\x02"
_MARKS, _MASKED = "{,[]", "\x03\x04\x05\x06"


def _count(text: Column, char: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, char, ""))).cast("long")


def _masked(text: Column) -> Column:
    """Text in which every quote begins or ends a string (undone by ``_plain``)."""
    return F.replace(F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))


def _plain(text: Column) -> Column:
    text = F.translate(text, _MASKED, _MARKS)
    return F.replace(F.replace(text, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))


def _outside(parts: Column, inside: int) -> Column:
    """What of a fragment's text between quotes is outside strings, if it begins so."""
    return F.array_join(F.filter(parts, lambda x, i: i % 2 == inside), "")


def _running(df: DataFrame, name: str, value: Column, at: str) -> DataFrame:
    """``at``: the sum of ``value`` over all rows of the file before this one.  The splits'
    totals, a small table, are summed in file order; inside a split a window does it."""
    by_split = ["file", "block"]
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (df.groupBy(*by_split).agg(F.sum(value).alias("_total"))
              .select(F.col("file").alias("_file"), F.col("block").alias("_block"), F.coalesce(
                  F.sum("_total").over(before.partitionBy("file")), F.lit(0)).alias("_start")))
    inner = Window.partitionBy(*by_split).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn(name, F.coalesce(F.sum(value).over(inner), F.lit(0)))
            .join(starts, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
            .withColumn(at, F.col("_start") + F.col(name)).drop("_file", "_block", "_start", name))


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, item_index, raw) of every element of the arrays at ``path``, one array a file.
    ``raw`` is the element's text; an element that is no object, and what an unfinished
    object left, come with their text too, so nothing is lost.  Commas, braces and escaped
    quotes in strings are text.  Objects inside a nested array count as elements."""
    text = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), _masked(F.col("value")).alias("text"))
    parts = F.split("text", '"')
    rows = text.withColumns({"quotes": _count(F.col("text"), '"'),
                             "open0": _count(_outside(parts, 0), "{"),
                             "open1": _count(_outside(parts, 1), "{")})
    # the file's last fragment is not followed by a brace
    last = (rows.groupBy("file").agg(F.max(F.struct("block", "row")).alias("l"))
            .select(F.col("file").alias("_f"), F.col("l.block").alias("_b"), F.col("l.row").alias("_r")))
    rows = (rows.join(last, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b"))
                      & (F.col("row") == F.col("_r")), "left")
            .withColumn("ends", F.col("_r").isNull()).drop("_f", "_b", "_r"))
    rows = _running(rows, "_q", F.col("quotes"), "before")
    inside = (F.col("before") % 2) == 1
    closes = (F.col("ends") & ((F.col("before") + F.col("quotes")) % 2 == 0)).cast("long")
    rows = rows.withColumns({"inside": inside, "closes": closes, "opens": F.when(
        inside, F.col("open1")).otherwise(F.col("open0"))})
    rows = _running(rows, "_d", F.col("opens") - F.col("closes"), "depth")
    # structural characters in strings masked: every brace and comma left is structure
    odd = F.when(F.col("inside"), F.lit(0)).otherwise(F.lit(1))
    shown = F.array_join(F.transform(parts, lambda x, i: F.when(
        i % 2 == odd, F.translate(x, _MARKS, _MASKED)).otherwise(x)), '"')
    top = (F.col("depth") <= 0) & ~F.col("inside")
    rows = rows.withColumn("shown", shown)
    rows = rows.withColumn("lead", F.when(top, F.substring_index("shown", "{", 1)).otherwise(F.lit("")))
    rows = rows.withColumn("commas", _count(F.col("lead"), ","))
    rows = _running(rows, "_c", F.col("commas"), "passed")
    rows = rows.withColumns({
        "item_index": F.col("passed") + F.col("commas"),
        "after": F.col("depth") + F.col("opens") - F.col("closes"),
        "body": F.concat(F.substr("shown", F.length("lead") + 1),
                         F.when(F.col("ends"), F.lit("}")).otherwise(F.lit("")))})
    objects = rows.filter((F.col("depth") > 0) | (F.col("opens") > 0))
    alone = (F.col("depth") <= 0) & (F.col("after") <= 0)
    spread = (objects.filter(~alone).groupBy("file", "item_index").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("block", "row", "body"))), lambda x: x["body"]), "")
        .alias("body")))
    whole = objects.filter(alone).select("file", "item_index", "body").unionByName(spread)
    others = (rows.filter(top).select("file", "passed", F.posexplode(F.split("lead", ",")).alias("k", "body"))
              .select("file", (F.col("passed") + F.col("k")).alias("item_index"),
                      F.regexp_replace("body", r"^[\s\[\]]+|[\s\[\]]+$", "").alias("body"))
              .filter("body <> ''"))
    return whole.unionByName(others).select("file", F.col("item_index").cast("long").alias("item_index"),
                                            _plain(F.col("body")).alias("raw"))
