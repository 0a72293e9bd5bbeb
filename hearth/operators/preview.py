"""Debug caps and previews: the first N rows, the first page, the first of each kind.

These limits are features (a debug run, a quick look), not ways to make a job
cheaper; full runs never pass through them.

SURVEY IDs: L2, L3, L6.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_n(df: DataFrame, n: int, order="seq") -> DataFrame:
    """The first ``n`` rows in ``order`` (TakeOrderedAndProject: top-n per task, then merged)."""
    orders = [order] if isinstance(order, str) else list(order)
    return df.orderBy(*orders).limit(n)


def first_page_only(df: DataFrame, page: str = "page") -> DataFrame:
    """Rows of the first page of each district (pages are numbered from 1)."""
    return df.filter(F.col(page) == 1)
