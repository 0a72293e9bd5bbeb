"""Region dimension: city -> districts, in two scopes ('all' and 'small').

A fixed, tiny table (a handful of rows per city), so broadcasting it is safe
by construction.  Only the scope name 'small' selects the small scope; any
other name means all districts.

SURVEY IDs: S2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Districts per city and scope as (Chinese name, URL slug), in order.
REGIONS = {
    "bj": {
        "all": [("朝阳区", "chaoyang"), ("海淀区", "haidian"), ("西城区", "xicheng")],
        "small": [("五道口", "wudaokou")],
    },
    "hz": {
        "all": [("钱塘区", "qiantangqu")],
        "small": [],
    },
    "hd": {
        "all": [("丛台区", "congtaiqu"), ("复兴区", "fuxingqu"), ("邯山区", "hanshanqu"),
                ("经开区", "jingkaiqu")],
        "small": [("丛台区", "congtaiqu")],
    },
}

REGION_SCHEMA = "city string, scope string, ord int, district_cn string, district_en string"


def scope_of(area_name: str) -> str:
    return "small" if area_name == "small" else "all"


def region_dim(spark: SparkSession) -> DataFrame:
    rows = [(city, scope, i, cn, en)
            for city, scopes in REGIONS.items()
            for scope, items in scopes.items()
            for i, (cn, en) in enumerate(items)]
    return spark.createDataFrame(rows, REGION_SCHEMA)


def districts(spark: SparkSession, city: str, area_name: str = "all") -> DataFrame:
    """The districts to collect for a city; an unknown city is an error."""
    if city not in REGIONS:
        raise ValueError(f"no districts defined for city {city!r}")
    return (region_dim(spark)
            .filter((F.col("city") == city) & (F.col("scope") == scope_of(area_name))))


def scoped_dimension(members: DataFrame, group: str, member_key: str) -> DataFrame:
    """Two scopes over any (group, member) dimension: every member under 'all',
    the first member of each group (lowest key) under 'small'.

    ``min`` is a partial aggregate, so a group holding most members still
    reduces map-side before the shuffle.
    """
    firsts = members.groupBy(group).agg(F.min(member_key).alias(member_key))
    small = members.join(firsts, [group, member_key], "left_semi").withColumn("scope", F.lit("small"))
    return members.withColumn("scope", F.lit("all")).unionByName(small)
