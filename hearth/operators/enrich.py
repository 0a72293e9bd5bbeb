"""Joins and set operations between stages: merge, resume, append.

Bag semantics throughout, as in the stage files: a listing that appears twice
and has two detail rows yields four merged rows.  Keys are never null (a card
without an id is rejected at extraction), so plain equi-joins are exact.

SURVEY IDs: J1, J2, P17, U1, U2, S8, L2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_inner(listings: DataFrame, details: DataFrame, key: str = "house_id",
                take: tuple[str, ...] = ("gallery",)) -> DataFrame:
    """listings x details on ``key`` (inner), keeping only ``take`` from details.

    The projection before the join keeps the shuffle narrow; Catalyst picks a
    broadcast only when AQE measures the detail side under the threshold.
    """
    right = details.select(key, *[c for c in take if c != key])
    return listings.join(right, key, "inner")


def pending(todo: DataFrame, done: DataFrame, key: str = "house_id") -> DataFrame:
    """Rows of ``todo`` whose key is not in ``done`` (left anti-join).

    Unlike ``NOT IN``, a null key in ``done`` does not empty the result.  The
    done keys are de-duplicated first: that aggregates map-side (a key stored
    many times costs one row per task) and the join reuses its partitioning.
    """
    return todo.join(done.select(key).distinct(), key, "left_anti")


def append_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows then new rows, matched by column name; absent columns are null."""
    return old.unionByName(new, allowMissingColumns=True)


def resume_batch(candidates: DataFrame, done: DataFrame, key: str = "house_id",
                 limit: int | None = None, order_by: str = "seq") -> DataFrame:
    """The next batch of work: candidates not done yet, optionally the first
    ``limit`` of them in ``order_by`` order (the debug cap)."""
    todo = pending(candidates, done, key)
    return todo.orderBy(order_by).limit(limit) if limit else todo
