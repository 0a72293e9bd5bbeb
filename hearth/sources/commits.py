"""Tables that grow by committed runs: staged files, and one manifest per run.

A run writes its files under a folder of its own, by day, and then publishes them with one
small file, its manifest.  Readers take the files that manifests name and nothing else,
so they see a run whole or not at all: a job killed while it writes leaves files that
nobody reads, and one that is run again under the same name after it was committed adds
nothing.  A run that replaces a day names the runs it replaces, so the old rows
go and the new ones come with the same file.

Layout under the table's path::

    data/commit_run=<run>/commit_attempt=<id>/dt=<yyyyMMdd>/part-*.parquet
    _runs/<run>.json            {"run", "attempt", "days", "replaces": [{"run", "day"}]}

Manifests are written beside their place and renamed into it; where the name is
taken the rename fails, so of two writers of one run one wins.  Replacing one day from two
jobs at once is the caller's to avoid.  Reading lists one line per run, whatever the rows.

SURVEY IDs: S7, S8.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLACE = "commit_run string, commit_attempt string"
_MANIFEST = "run string, attempt string, days array<string>, replaces array<struct<run:string, day:string>>"


@dataclass(frozen=True)
class Run:
    """A committed run: where its files lie and the days of it that still count."""
    run: str
    attempt: str
    days: tuple[str, ...]


def _store(spark: SparkSession, path: str):
    """The file system of ``path``, and ``path`` as its own type."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, place = _store(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def _nullable(kind: T.DataType) -> T.DataType:
    """The type as files hold it: anything in it may be null."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    return kind


class CommitLog:
    """One table at ``path``; ``schema`` holds its columns, ``dt`` (text) among them."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path = spark, path.rstrip("/")
        self.columns = T.StructType([f for f in schema.fields if f.name != "dt"])

    def _manifests(self) -> list:
        try:
            return self.spark.read.schema(_MANIFEST).option("mode", "FAILFAST").json(f"{self.path}/_runs").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def runs(self) -> list[Run]:
        """The committed runs, by name, without the days that others replaced."""
        found = self._manifests()
        gone = {(r["run"], r["day"]) for m in found for r in m["replaces"]}
        return [Run(m["run"], m["attempt"], tuple(d for d in m["days"] if (m["run"], d) not in gone)) for m in sorted(found, key=lambda m: m["run"])]

    def exists(self) -> bool:
        fs, place = _store(self.spark, f"{self.path}/_runs")
        return fs.exists(place)

    def has(self, run: str) -> bool:
        fs, place = _store(self.spark, f"{self.path}/_runs/{run}.json")
        return fs.exists(place)

    def stage(self, df: DataFrame, run: str) -> str:
        """Write a run's files where no reader looks yet; gives the attempt's name.

        Columns are put in the table's order by name; one that ``df`` lacks is null.
        """
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", run):
            raise ValueError(f"not a run name: {run!r}")
        attempt = uuid.uuid4().hex
        names = [(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(_nullable(f.dataType)).alias(f.name) for f in self.columns.fields]
        df.select(*names, F.col("dt").cast("string").alias("dt")).write.partitionBy("dt").parquet(f"{self.path}/data/commit_run={run}/commit_attempt={attempt}")
        return attempt

    def commit(self, run: str, attempt: str, replaces: list[tuple[str, str]] = ()) -> bool:
        """Publish a staged attempt; false if the run had been published already."""
        days = [d[3:] for d in _names(self.spark, f"{self.path}/data/commit_run={run}/commit_attempt={attempt}") if d.startswith("dt=")]
        text = json.dumps({"run": run, "attempt": attempt, "days": days, "replaces": [{"run": r, "day": d} for r, d in replaces]})
        jvm = self.spark.sparkContext._jvm
        fs, new = _store(self.spark, f"{self.path}/_runs/.{run}.{attempt}")
        _, final = _store(self.spark, f"{self.path}/_runs/{run}.json")
        out = fs.create(new, False)
        out.write(bytearray(text.encode()))
        out.close()
        place = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        never_over = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            place.rename(new, final, never_over)
        except Exception:
            fs.delete(new, False)
            if self.has(run):
                return False
            raise
        return True

    def append(self, df: DataFrame, run: str) -> bool:
        """Add ``df`` as ``run``, once: false (and nothing computed) if that run is there already."""
        return not self.has(run) and self.commit(run, self.stage(df, run))

    def replace(self, df: DataFrame, run: str, day: str | None = None) -> bool:
        """As ``append``, in place of what is stored for ``day`` (or for each day that ``df`` has rows of)."""
        if self.has(run):
            return False
        attempt = self.stage(df if day is None else df.withColumn("dt", F.lit(day)), run)
        new = {d[3:] for d in _names(self.spark, f"{self.path}/data/commit_run={run}/commit_attempt={attempt}") if d.startswith("dt=")} if day is None else {day}
        return self.commit(run, attempt, [(r.run, d) for r in self.runs() for d in r.days if d in new])

    def read(self, day: str | None = None, only: set[str] | None = None, without: set[str] = frozenset()) -> DataFrame:
        """The committed rows; ``day`` reads that day's files alone, ``only`` and ``without`` choose by run."""
        paths = [f"{self.path}/data/commit_run={r.run}/commit_attempt={r.attempt}/dt={d}" for r in self.runs() for d in r.days
                 if day in (None, d) and r.run not in without and (only is None or r.run in only)]
        return self._files(paths, f"{self.path}/data", _PLACE)

    def _files(self, paths: list[str], base: str, place: str) -> DataFrame:
        dt = T.StructField("dt", T.StringType())
        if not paths:
            return self.spark.createDataFrame([], T.StructType([*self.columns.fields, dt]))
        above = T.StructType.fromDDL(place).fields if place else []
        fields = T.StructType([*self.columns.fields, *above, dt])
        return self.spark.read.schema(fields).option("basePath", base).parquet(*paths).drop(*[f.name for f in above])

    def plain(self, day: str | None = None) -> DataFrame | None:
        """Rows in plain ``dt=`` folders right below the path (written without runs); null if there are none."""
        days = [d for d in _names(self.spark, self.path) if d.startswith("dt=")]
        if not days:
            return None
        return self._files([f"{self.path}/{d}" for d in days if day in (None, d[3:])], self.path, "")

    def adopt(self) -> None:
        """Take plain ``dt=`` folders over as a first run, before a committed one hides them."""
        if not self.exists():
            old = self.plain()
            if old is not None:
                self.append(old, "adopted")

    def vacuum(self, keep: set[str] = frozenset()) -> list[str]:
        """Delete files that no committed run needs: attempts never published, and replaced days.

        ``keep`` names attempts still being written.  Gives the folders that went.
        """
        runs = {(f"commit_run={r.run}", f"commit_attempt={r.attempt}"): r.days for r in self.runs()}
        gone = []
        for run in _names(self.spark, f"{self.path}/data"):
            for attempt in _names(self.spark, f"{self.path}/data/{run}"):
                place = f"{self.path}/data/{run}/{attempt}"
                if attempt.removeprefix("commit_attempt=") in keep:
                    continue
                if (run, attempt) not in runs:
                    gone.append(place)
                else:
                    gone += [f"{place}/{d}" for d in _names(self.spark, place) if d.startswith("dt=") and d[3:] not in runs[run, attempt]]
        for g in gone:
            fs, place = _store(self.spark, g)
            fs.delete(place, True)
        return gone
