"""Bucketed stage tables: joins on their key leave the stored side where it lies."""

import pytest
from pyspark.sql import functions as F

from hearth.operators import enrich
from hearth.sources import buckets


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def table(spark, path, n, **more):
    df = spark.range(n).select((F.col("id") % 50).alias("house_id"), F.col("id").alias("v"), *[F.lit(v).alias(k) for k, v in more.items()])
    buckets.append_bucketed(df, path, buckets=8)
    return buckets.read_bucketed(spark, path)


def test_merge_plans_no_exchange(spark, scratch, no_broadcast):
    listings, details = table(spark, f"{scratch}/a", 60, title="t"), table(spark, f"{scratch}/b", 100, gallery="g")
    out = enrich.merge_inner(listings, details)
    assert "Exchange" not in plan_of(out) and "SortMergeJoin" in plan_of(out)
    assert out.count() == 60 * 2


def test_resume_shuffles_only_what_is_new(spark, scratch, no_broadcast):
    done = table(spark, f"{scratch}/done", 100)
    todo = spark.range(80).select(F.col("id").alias("house_id"), F.lit("x").alias("page"))
    out = enrich.pending(todo, done)
    left, right = plan_of(out).split("FileScan parquet", 1)[0], plan_of(out)
    assert "Bucketed: true" in right and left.count("Exchange") == 1  # that of the new rows
    assert sorted(r.house_id for r in out.collect()) == list(range(50, 80))
    stored = enrich.pending(table(spark, f"{scratch}/todo", 10, page="x"), done)
    assert "Exchange" not in plan_of(stored) and stored.count() == 0


def test_appends_reopen_and_mismatch(spark, scratch):
    path = f"{scratch}/t"
    table(spark, path, 10)
    spark.sql(f"DROP TABLE {buckets._name(path)}")             # as in a later session
    buckets.append_bucketed(spark.createDataFrame([(7, None)], "v bigint, house_id bigint"), path)
    got = buckets.read_bucketed(spark, path)
    assert got.count() == 11 and got.filter("house_id is null and v = 7").count() == 1
    with pytest.raises(ValueError):
        buckets.append_bucketed(got, path, buckets=3)
    with pytest.raises(FileNotFoundError):
        buckets.read_bucketed(spark, f"{scratch}/none")
