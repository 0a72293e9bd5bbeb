"""Stage tables on shared storage: parquet as the main form, CSV for exchange.

Layout: one committed table (``sources.commits``) per stage under ``<root>/<stage>``, by day;
``schema.STAGES`` names the stages and what they hold.

SURVEY IDs: S5-S9.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.errors import AnalysisException

from hearth.schema import IMAGES, INDEX_COLUMNS, LEGACY_NAMES, PAGES, stage_schema
from hearth.schema import STAGES as STAGE_SCHEMAS
from hearth.sources import csvrecords
from hearth.sources.commits import CommitLog

STAGES = tuple(STAGE_SCHEMAS)


def snapshot_date(day: _dt.date | None = None) -> str:
    """``yyyyMMdd`` of the run date (the partition value)."""
    return (day or _dt.date.today()).strftime("%Y%m%d")


def stage_path(root: str, stage: str) -> str:
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}")
    return f"{root.rstrip('/')}/{stage}"


def stage_log(spark: SparkSession, root: str, stage: str, schema: T.StructType | None = None) -> CommitLog:
    return CommitLog(spark, stage_path(root, stage), schema or stage_schema(stage))


def new_run() -> str:
    """A name for a run whose caller gave none (so it is never taken for a repeat)."""
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


def write_stage(df: DataFrame, root: str, stage: str, dt: str | None = None, run: str | None = None) -> str:
    """Write a stage table.

    With ``dt`` that day's rows are replaced by ``df``, also by none of its rows;
    other days stay.  Without it ``df`` carries a ``dt`` column and the days
    found in it are replaced.  Readers see the old day or the new one, never a part
    of either.
    """
    log = stage_log(df.sparkSession, root, stage)
    log.adopt()
    log.replace(df, run or new_run(), dt)
    return log.path


def read_stage(spark: SparkSession, root: str, stage: str, schema: T.StructType | None = None,
               dt: str | None = None, without_run: str | None = None) -> DataFrame:
    """Read a stage table by its declared schema; ``dt`` prunes to one snapshot.

    Committed runs alone are read (but for ``without_run``).  A folder of plain ``dt=`` partitions without any run (an older
    stage, or one written elsewhere) is read as it lies.  ``dt`` is text whatever
    the session's partition type inference says.
    """
    log = stage_log(spark, root, stage, schema)
    if not log.exists():
        old = log.plain(dt)
        if old is not None:
            return old
        spark.read.schema("run string").json(f"{log.path}/_runs")  # raises: there is no such table
    return log.read(dt, without={without_run} if without_run else frozenset())


def read_stage_if_any(spark: SparkSession, root: str, stage: str, dt: str | None = None, without_run: str | None = None) -> DataFrame:
    """As ``read_stage``; a table that was never written is empty.

    Only a missing path counts as that.  Any other failure to read (no permission, a
    throttled store) is raised: taking it for "nothing done yet" would repeat the work.
    """
    try:
        return read_stage(spark, root, stage, dt=dt, without_run=without_run)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], stage_schema(stage))


def append_stage(df: DataFrame, root: str, stage: str, run: str | None = None) -> bool:
    """Add rows to a stage table by their ``dt`` (a missing table is created).

    ``run`` names the work that made them: a run that was committed before adds nothing, so a
    job can be started again after any failure.  False says that it was there.
    """
    log = stage_log(df.sparkSession, root, stage)
    log.adopt()
    return log.append(df, run or new_run())


# --- CSV exchange ------------------------------------------------------------

def snapshot_day(c) -> Column:
    """``yyyyMMdd`` of a date or time column: the partition value of its day."""
    return F.date_format(c, "yyyyMMdd")


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType, newlines: bool = True,
                   seq: str | None = None) -> DataFrame:
    """CSV with a header -> ``schema``, matching columns by name.

    ``newlines``: fields may hold line breaks (``csvrecords``: large files are still read by several
    tasks, at the price of a shuffle).  Without them no shuffle is needed.
    ``seq`` adds a number that keeps the rows' order, file by file in the order of their names
    (with ``newlines`` only).

    Only the header is inspected (every column read as text, no inference
    pass); misspelt legacy names are mapped, a leftover index column is dropped,
    and values are cast with ``try_cast`` so bad text becomes null.  A UTF-8 BOM
    is removed by the reader.
    """
    plain = (spark.read.option("header", True).option("escape", '"')
             .option("multiLine", newlines).option("inferSchema", False).csv(path))
    names = [c.lstrip("\ufeff") for c in plain.columns]
    renamed = [LEGACY_NAMES.get(n, n) for n in names]
    raw = plain
    if newlines:
        raw = csvrecords.fields(csvrecords.records(spark, path), [f"_{i}" for i in range(len(names))])
    at = {n: (f"_{i}" if newlines else plain.columns[i]) for i, n in enumerate(renamed) if names[i] not in INDEX_COLUMNS}
    cols = [(F.col(f"`{at[f.name]}`").try_cast(f.dataType) if f.name in at else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    if seq:
        bare = r"^file:/+"  # the two ways to name a local file differ in slashes
        order = [re.sub(bare, "/", f) for f in sorted(plain.inputFiles())]
        rank = F.array_position(F.array(*[F.lit(f) for f in order]), F.regexp_replace("_file", bare, "/"))
        cols.append((F.coalesce(rank, F.lit(0)) * F.lit(1 << 44) + F.col("_place")).cast("bigint").alias(seq))
    return raw.select(*cols)


def write_csv_table(df: DataFrame, path: str, mode: str = "overwrite", bom: bool = True) -> str:
    """CSV export with a header; quotes are doubled (``escape='"'``), not backslashed.

    ``bom`` starts each file's header with a UTF-8 byte order mark, so that
    spreadsheet programs read the text as UTF-8; readers here strip it.  Nested
    columns are written as JSON text.
    """
    flat = df.select(*[
        (F.to_json(F.col(f"`{f.name}`"))
         if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f"`{f.name}`"))
        .alias(("\ufeff" if bom and i == 0 else "") + f.name)
        for i, f in enumerate(df.schema.fields)])
    (flat.write.mode(mode).option("header", True).option("escape", '"').option("encoding", "UTF-8")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


# --- landed inputs -------------------------------------------------------------

def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages ``(page_id, url, html[, district])`` (fetching is done elsewhere).

    Pages that carry no district have a null one.
    """
    return spark.read.schema(T.StructType(PAGES.fields + [T.StructField("district", T.StringType())])).parquet(path)


def read_images(spark: SparkSession, path: str, url_root: str | None = None) -> DataFrame:
    """Landed image files -> ``(url, content)``.

    ``binaryFile`` reads each file whole into one row.  When ``url_root`` is
    given, the landing folder prefix is replaced by it so that ``url`` matches
    the gallery URLs.
    """
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
          .select(F.col("path").alias("url"), "content"))
    if url_root is not None:
        prefix = path.rstrip("/").split(":", 1)[-1] if path.startswith("file:") else path.rstrip("/")
        at = F.locate(prefix, F.col("url")) + len(prefix)
        df = df.withColumn("url", F.concat(F.lit(url_root.rstrip("/")), F.substring(F.col("url"), at, F.length("url"))))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in IMAGES.fields])
