"""Tables stored in buckets of a key, so that joins on it do not shuffle what is stored.

Every bucket is written sorted by the key.  Two tables with equal keys and bucket numbers join
without any exchange; against one of them only the other side travels, into its
buckets.  The key and the number of buckets are kept beside the files, and each session
enters the table in its catalog from there.

Choose buckets for the table at its full size (about 256 MB each), and at least as many as
``spark.sql.shuffle.partitions``: Spark may prefer to shuffle both sides where a
table has fewer.

SURVEY IDs: J1, J2 (stored sides).
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ABOUT = "key string, buckets int, columns string"


def _name(path: str) -> str:
    return "buckets_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def _about(spark: SparkSession, path: str):
    try:
        return spark.read.schema(_ABOUT).parquet(f"{path.rstrip('/')}/about").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _enter(spark: SparkSession, path: str, about) -> str:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(path)} ({about['columns']}) USING parquet CLUSTERED BY (`{about['key']}`) "
              f"SORTED BY (`{about['key']}`) INTO {about['buckets']} BUCKETS LOCATION '{path.rstrip('/')}/rows'")
    return _name(path)


def append_bucketed(df: DataFrame, path: str, key: str = "house_id", buckets: int | None = None) -> None:
    """Add ``df`` to the table at ``path``, which is made where there is none (``buckets``: the shuffle partitions, if not given).

    Rows are dealt out by the key, so a write makes one file per bucket.  A null key has a bucket like any other.
    """
    spark = df.sparkSession
    about = _about(spark, path)
    if about is None:
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        (spark.range(1).select(F.lit(key).alias("key"), F.lit(n).alias("buckets"), F.lit(columns).alias("columns"))
         .write.parquet(f"{path.rstrip('/')}/about"))
        about = {"key": key, "buckets": n, "columns": columns}
    elif about["key"] != key or buckets not in (None, about["buckets"]):
        raise ValueError(f"{path} has {about['buckets']} buckets by {about['key']}")
    name = _enter(spark, path, about)
    (df.select(*[F.col(f"`{c}`") for c in spark.table(name).columns]).repartition(about["buckets"], key).write.format("parquet").mode("append")
     .bucketBy(about["buckets"], key).sortBy(key).saveAsTable(name))


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``; raises ``FileNotFoundError`` where there is none."""
    about = _about(spark, path)
    if about is None:
        raise FileNotFoundError(path)
    return spark.table(_enter(spark, path, about))
