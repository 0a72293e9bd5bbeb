"""Stage counters as a ``metrics(stage, name, value)`` table.

Counts are conditional aggregates computed in a single pass over a stage
(one partial aggregate per task, one tiny final row), then unpivoted.

SURVEY IDs: A4, A5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def stage_metrics(df: DataFrame, stage: str, counters: dict[str, Column]) -> DataFrame:
    """One row per counter: ``counters`` maps a name to a condition (or None = all rows)."""
    aggs = [(F.count(F.lit(1)) if cond is None else count_where(cond)).cast("bigint").alias(name)
            for name, cond in counters.items()]
    wide = df.agg(*aggs)
    names = list(counters)
    return (wide.unpivot([], names, "name", "value")
            .select(F.lit(stage).alias("stage"), "name", F.col("value").cast("bigint")))


def before_after(before: DataFrame, after: DataFrame, stage: str) -> DataFrame:
    """Row counts before and after a stage (two scans; prefer ``stage_metrics``
    over one plan with a ``kept`` condition when both halves come from one table)."""
    b = before.agg(F.count(F.lit(1)).alias("value")).select(F.lit("before").alias("name"), "value")
    a = after.agg(F.count(F.lit(1)).alias("value")).select(F.lit("after").alias("name"), "value")
    return b.unionByName(a).select(F.lit(stage).alias("stage"), "name",
                                   F.col("value").cast("bigint"))
