"""CSV files whose fields hold line breaks, read by many tasks.

A line break ends a record unless it stands between quotes, that is after an odd number of quote
signs.  Files are read as lines by their splits; a split's own parity and that of
the splits before it (one slim row each) tell which of its lines begin a record.  Records
of one line, which are nearly all, go on as they are; the lines of the others are
brought together by the record they belong to, also across splits.

Quotes inside a field are doubled, so they do not change the parity; a lone quote sign
inside an unquoted field is not CSV and would be taken for an opening one.

SURVEY ID: S5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'
#: What the parser puts for a field without any text, so that a quoted empty field stays empty (a private-use sign).
NOTHING = "\ue000"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    line = F.regexp_replace("value", "\r$", "")
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("at"), line.alias("line"), (quotes % 2).alias("odd"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, place, record)``: each file's records with their line breaks; ``place`` orders them within it.

    Blank lines between records are none.  A byte order mark before the first record is removed.
    """
    lines = _lines(spark, path)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    flips = lines.groupBy("file", "block").agg((F.sum("odd") % 2).alias("flip"))
    opened = flips.select("file", "block", (F.coalesce(F.sum("flip").over(before), F.lit(0)) % 2).alias("open"))
    own = Window.partitionBy("file", "block").orderBy("at")
    inside = F.coalesce(F.sum("odd").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("open")
    first = lines.join(opened, ["file", "block"]).withColumn("begins", inside % 2 == 0)
    nth = first.withColumn("nth", F.sum(F.col("begins").cast("int")).over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # a split that begins within a record goes on with the last one begun before it
    last = F.last(F.when(F.col("n") > 0, F.col("block") + F.col("n")), ignorenulls=True).over(before)
    ends = nth.groupBy("file", "block").agg(F.max("nth").alias("n")).select("file", "block", last.alias("last"))
    # a record has at least a byte, so block start + number grows along the file and is unique in it
    placed = nth.join(ends, ["file", "block"]).select(
        "file", "block", "at", "line", "odd", "begins", F.when(F.col("nth") > 0, F.col("block") + F.col("nth")).otherwise(F.col("last")).alias("place"))
    whole = F.col("begins") & (F.col("odd") == 0)
    one = placed.filter(whole).select("file", "place", F.col("line").alias("record"))
    parts = F.sort_array(F.collect_list(F.struct("block", "at", "line")))
    many = (placed.filter(~whole).groupBy("file", "place").agg(parts.alias("parts"))
            .select("file", "place", F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("record")))
    both = one.unionByName(many).filter("trim(record) <> ''")
    bom = F.when(F.col("place") == 1, F.regexp_replace("record", "^﻿", "")).otherwise(F.col("record"))
    return both.select("file", "place", bom.alias("record"))


def fields(found: DataFrame, names: list[str]) -> DataFrame:
    """The records' fields as text columns ``names``, with ``file`` and ``place`` as ``_file`` and ``_place``; headers (each file's first record) are left out."""
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    row = F.from_csv("record", schema, {"quote": QUOTE, "escape": QUOTE, "mode": "PERMISSIVE", "nullValue": NOTHING, "emptyValue": ""})
    return (found.filter("place > 1")  # a file's first line begins its first record
            .select(F.col("file").alias("_file"), F.col("place").alias("_place"), row.alias("row"))
            .select("_file", "_place", *[F.col(f"row.c{i}").alias(n) for i, n in enumerate(names)]))
