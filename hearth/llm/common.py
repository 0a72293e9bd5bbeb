"""Helpers that the operators share."""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.session import checkpoint_root

#: ASCII white space as the contracts count words: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and read it back.

    Ends the lineage: what several later steps read is computed once, and a
    lost executor costs no recomputation of the text passes behind it.  Unlike
    ``checkpoint()`` the plan runs once and later reads stay columnar.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def row_key(text: str | Column = "text") -> Column:
    """Tells rows that share an id but not a text apart (null reads as empty)."""
    return F.xxhash64(text_or_empty(text))


def spread(df: DataFrame) -> DataFrame:
    """Deal rows of a slim table out evenly before heavy per-row work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def by_turns(rows: list[tuple], chars: int) -> list[tuple]:
    """Of ``(group, key, size)`` rows those that fit into ``chars`` in all; groups take turns, each in the order of its keys.

    A row that does not fit is left out alone, and the next ones are tried.  Raises
    ValueError if nothing of a group fits, so that no group goes missing unnoticed.
    """
    turn, queue = Counter(), []
    for group, key, size in sorted(rows):
        queue.append((turn[group], group, key, size))
        turn[group] += 1
    out, left = [], chars
    for _, group, key, size in sorted(queue):
        if size <= left:
            out.append((group, key))
            left -= size
    missing = turn.keys() - {g for g, _ in out}
    if missing:
        raise ValueError(f"no training text of {sorted(missing)} fits into {chars} characters")
    return out
