"""The digest index against plain Python, over one and several deliveries."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from hearth.llm import exactindex as X
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck


def brute(rows):
    """[(id, text)] -> sorted (id, keep_id, group_size, kept, sha256)."""
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), d is None, d or 0))
    out = []
    for d, t in rows:
        plain = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best = min(groups[plain])
        out.append((d, None if best[1] else best[2], len(groups[plain]), (-len(t or ""), d is None, d or 0) == best,
                    hashlib.sha256(plain.encode()).hexdigest()))
    return sorted(out, key=str)


def told(df):
    return sorted((tuple(r) for r in df.select("id", "keep_id", "group_size", "kept", F.lower(F.hex("digest"))).collect()), key=str)


ROWS = [(5, "same text"), (2, "same  text"), (9, "same\n\ttext "), (1, "sametext"), (3, None), (4, ""), (6, " \r\n\x0b\x0c "), (7, "other"),
        (8, "other"), (8, "other"), (None, "other"), (None, "of no id"), (None, "of no  id"), (-3, "same\n\t text"), (11, "é🙂 x"), (10, "é🙂x "),
        (12, "\xa0other"), (13, "long " * 200_000), (14, "long" * 200_000), (2 ** 62, "far"), (-2 ** 63, "far"), (2 ** 63 - 1, "f a r")]


@pytest.fixture()
def index(spark, scratch):
    return X.open_index(spark, f"{scratch}/index", 4)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_one_delivery(spark, index):
    assert told(X.exact_duplicates(frame(spark, ROWS), index, "a")) == brute(ROWS)


def test_deliveries_add_up_and_repeats_add_nothing(spark, scratch, index):
    rnd = random.Random(4)
    rows = [(i, rnd.choice("abc") + " " * rnd.randint(0, 3) + rnd.choice("de")) for i in range(300)] + ROWS
    rnd.shuffle(rows)
    parts = [rows[:100], rows[100:180], [], rows[180:]]
    for k, part in enumerate(parts):
        X.exact_duplicates(frame(spark, part), index, str(k))
    X.exact_duplicates(frame(spark, parts[1]), index, "1")  # run again
    again = X.open_index(spark, f"{scratch}/index")  # as a later session finds it
    assert again.buckets == 4
    assert told(X.decide(again, X.digests(frame(spark, rows)))) == brute(rows)
    firsts = again.entries().filter("is_first")
    assert firsts.count() == firsts.select("digest").distinct().count() == again.state().count()


def test_interrupted_delivery_leaves_nothing(spark, index):
    bad = frame(spark, ROWS).withColumn("text", F.when(F.col("doc_id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        X.add(index, X.digests(bad), "a")
    assert index.entries().isEmpty()
    assert told(X.exact_duplicates(frame(spark, ROWS), index, "a")) == brute(ROWS)


def test_unseen_rows_come_back_whole(spark, index):
    X.exact_duplicates(frame(spark, ROWS[:6]), index, "a")
    new = frame(spark, [(100, "same text"), (101, "news"), (102, "ne ws"), (103, None)]).withColumn("digest", F.lit("mine")).withColumn("n", F.lit(1))
    assert sorted(tuple(r) for r in X.unseen(new, index).collect()) == [(101, "news", "mine", 1), (102, "ne ws", "mine", 1)]


def test_empty_table_and_clashing_columns(spark, index):
    assert X.exact_duplicates(frame(spark, []), index, "a").isEmpty()
    more = frame(spark, ROWS).select("*", *[F.lit("x").alias(c) for c in ("id", "digest", "rank", "share", "best", "n", "chars")])
    assert told(X.exact_duplicates(more, index, "b")) == brute(ROWS)


def test_the_stored_side_is_not_shuffled(spark, index):
    X.exact_duplicates(frame(spark, ROWS), index, "a")
    plan = index.state()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    group = frame(spark, ROWS).select(F.unhex(F.sha2("text", 256)).alias("digest")).distinct()
    anti = group.join(index.entries().filter("is_first").select("digest").hint("merge"), "digest", "left_anti")
    plan = anti._jdf.queryExecution().executedPlan().toString()
    stored = plan[plan.index("SortMergeJoin"):].rsplit("FileScan", 1)
    assert "LeftAnti" in plan and "Bucketed: true" in stored[1] and stored[0].count("Exchange hashpartitioning(digest") == 1
    assert "Python" not in plan and "Arrow" not in plan


def test_hot_text_is_dealt_over_shares(spark):
    rows = X.digests(spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("one text").alias("text")))
    most = rows.groupBy("digest", "share").count().agg(F.max("count")).first()[0]
    assert most <= 20_000 // X.SHARES + 8


def test_query_matches_sql(spark):
    name = "op12_exact_dedup"
    r = compare(spark, duck(SF_SMALL), SF_SMALL, name, E.queries()[name], E.oracle_sql()[name])
    assert r["ok"], r
