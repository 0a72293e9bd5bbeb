"""Exact duplicates by a persistent digest index (operator 12), native.

Texts are equal when they are the same once all ASCII white space is gone; the
SHA-256 of what is left stands for them.  The index is a table on shared
storage, bucketed and sorted by digest, to which deliveries are only ever appended:

* a delivery's rows are reduced to one group per digest before anything meets the index;
* a sort-merge anti-join with the index finds the digests that are new, and those are
  appended as first entries;
* the others are appended as further entries of their digest (how many rows came, and
  the best of them), so nothing stored is rewritten.

A digest's state is the aggregate of its entries.  Index and aggregate share the
buckets, so neither the joins nor the state shuffle what is stored.  A delivery
carries a name and is written in one commit: one that was interrupted left nothing, and
one that is run again adds nothing.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.common import cut, text_or_empty

#: What equal texts may differ in: space and \t \n \v \f \r.
BLANKS = " \t\n\x0b\x0c\r"
#: A digest's rows are dealt over so many shares, so that a text that very many rows repeat is no single key.
SHARES = 1024
_ENTRY = "digest binary, best decimal(38,0), n bigint, delivery string, is_first boolean"
_STEP, _TOP = f"CAST('1{'0' * 20}' AS DECIMAL(21,0))", f"CAST('{2 ** 63}' AS DECIMAL(20,0))"


def rank_of(chars: str = "chars", row_id: str = "id") -> Column:
    """One number that orders rows: more code points first, then the smaller id, null ids last."""
    return F.expr(f"CAST(CAST({chars} AS DECIMAL(10,0)) * {_STEP} + coalesce({_TOP} - {row_id}, 0) AS DECIMAL(38,0))")


def id_of(rank: str) -> Column:
    """The id that ``rank_of`` was made with."""
    low = f"CAST({rank} % {_STEP} AS DECIMAL(21,0))"
    return F.expr(f"CASE WHEN {low} > 0 THEN CAST({_TOP} - {low} AS BIGINT) END")


@dataclass(frozen=True)
class Index:
    """A digest index at ``path``; ``name`` is its table in this session's catalog."""
    spark: SparkSession
    path: str
    name: str
    buckets: int

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def state(self) -> DataFrame:
        """``(digest, best, n)``: every digest's best row and number of rows; buckets hold whole digests."""
        return self.entries().groupBy("digest").agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def open_index(spark: SparkSession, path: str, buckets: int | None = None) -> Index:
    """The index at ``path``, made with ``buckets`` (the shuffle partitions, if not given) where there is none.

    The number is kept beside the entries, and later sessions read it from there.
    """
    about = f"{path.rstrip('/')}/about"
    try:
        buckets = spark.read.schema("buckets int").parquet(about).first()["buckets"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(about)
    name = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ENTRY}) USING parquet CLUSTERED BY (digest) "
              f"SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path.rstrip('/')}/entries'")
    return Index(spark, path, name, buckets)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, rank, digest, share)`` of every row, without its text."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.length(text).alias("chars"),
                       F.unhex(F.sha2(F.translate(text, BLANKS, ""), 256)).alias("digest"))
    return rows.select("id", rank_of().alias("rank"), "digest", (F.monotonically_increasing_id() % SHARES).cast("int").alias("share"))


def add(index: Index, rows: DataFrame, delivery: str) -> None:
    """Append a delivery's ``digests`` to the index; a delivery that is there already adds nothing."""
    if not index.entries().filter(F.col("delivery") == delivery).isEmpty():
        return
    # shares first: a repeated digest reaches its group as at most SHARES rows
    share = rows.groupBy("digest", "share").agg(F.max("rank").alias("best"), F.count(F.lit(1)).alias("n"))
    group = cut(share.groupBy("digest").agg(F.max("best").alias("best"), F.sum("n").alias("n")))
    known = index.entries().filter("is_first").select("digest").hint("merge")
    fresh = group.join(known, "digest", "left_anti").withColumn("is_first", F.lit(True))
    again = group.join(known, "digest", "left_semi").withColumn("is_first", F.lit(False))
    (fresh.unionByName(again).select("digest", "best", "n", F.lit(delivery).alias("delivery"), "is_first")
     .repartition(index.buckets, "digest").write.format("parquet").mode("append")
     .bucketBy(index.buckets, "digest").sortBy("digest").saveAsTable(index.name))


def decide(index: Index, rows: DataFrame) -> DataFrame:
    """``(id, keep_id, group_size, kept, digest)`` for each of ``digests``' rows, by all that the index holds."""
    share = rows.select("digest", "share").distinct()
    dealt = share.join(index.state(), "digest")
    return rows.join(dealt, ["digest", "share"]).select(
        "id", id_of("best").alias("keep_id"), F.col("n").alias("group_size"), (F.col("rank") == F.col("best")).alias("kept"), "digest")


def exact_duplicates(docs: DataFrame, index: Index, delivery: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add ``docs`` to ``index`` and say of each row which one stays: ``(id, keep_id, group_size, kept, digest)``.

    Of equal texts the one with the most code points stays, then the one with the smallest
    id; a null id comes last.  Earlier deliveries count, so ``keep_id`` may be a row
    of one of those.  A null text is an empty one, and all texts without anything but
    white space are equal.  Rows that repeat an id and a text are told apart by
    nothing, so all of them say ``kept`` if one does.  An empty table gives no rows and
    adds none; other columns are not read.
    """
    rows = cut(digests(docs, id_col, text_col))
    add(index, rows, delivery)
    return decide(index, rows)


def unseen(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, whose text is not in ``index`` yet (repeats among them stay)."""
    own = docs.withColumn("__digest", F.unhex(F.sha2(F.translate(text_or_empty(text_col), BLANKS, ""), 256)))
    known = index.entries().filter("is_first").select(F.col("digest").alias("__digest")).hint("merge")
    return own.join(known, "__digest", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
