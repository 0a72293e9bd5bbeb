"""Mixing against a plain version of its definition."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hearth.llm import mixing
from tests.conftest import SF_SMALL


def plain_targets(sizes, weights=(3, 1, 2)):
    """{source: size} -> {source: target}, sharing the excess again until none is left."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > 2 * sizes[s]}
        if not over:
            out.update({s: level * w[s] for s in free})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def plain_mix(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    total = defaultdict(int)
    for (_, _, s), n in zip(rows, size):
        total[s] += n
    goal, out = plain_targets(total), []
    for s in total:
        own = []
        for (d, t, x), n in zip(rows, size):
            if x == s:
                u = (int(hashlib.md5(f"mix{'' if d is None else d}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
                q = 1.0 if 4 * n <= len(t or "") <= 11 * n else 0.25
                own.append((-math.log(u) / q, d is None, d or 0, n))
        epochs = int(goal[s] // total[s]) if total[s] else 0
        rest, run = goal[s] - epochs * total[s], 0
        for key, z, d, n in sorted(own):
            run += n
            out.append((None if z else d, n, total[s], round(goal[s], 6), n * (epochs + (run - n / 2 < rest))))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=str)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert got(mixing.mix(docs)) == plain_mix(rows) == got(mixing.mix(docs.repartition(7), buckets=3))


def edge_rows():
    rows = [(i, "word " * (i % 13 + 1), ["b", "a", None, "ä", "Z", "big"][min(i % 9, 5)]) for i in range(300)]
    return rows + [(400, None, "a"), (401, "", "a"), (402, " \t", "empty"), (None, "some null id", "a"), (403, "x" * 50000, "b"), (404, "a b " * 30000, "long"),
                   (405, "same row", "dup"), (405, "same row", "dup")]


def test_edges(spark):
    df = spark.createDataFrame([(*r, "clash") for r in edge_rows()], "doc_id long, text string, source string, size string")
    out = mixing.mix(df)
    assert got(out) == plain_mix(edge_rows())
    for r in out.collect():
        assert r.taken <= 2 * r.size and (r.size == 0) <= (r.taken == 0)
    taken = mixing.take(df)
    assert taken.columns == [*df.columns, "copies", "taken"]
    assert sum(r.taken for r in taken.collect()) == sum(r.taken for r in out.collect())


def test_targets(spark):
    sizes = {"a": 100, "b": 10, "c": 1000, None: 5, "z": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    for share in (1.5, 2.0):
        out = {r.source: r.target for r in mixing.targets(df, (3, 1, 2), share, 2.0).collect()}
        assert sum(out.values()) == pytest.approx(share * 1115)
        if share == 1.5:
            assert out == pytest.approx(plain_targets(sizes))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(df).count() == 0 and mixing.take(df).count() == 0


def test_buckets_keep_the_order_and_hold_like_shares(spark):
    keys = spark.range(40_000).select(F.col("id"), (-F.log(mixing.uniform(F.col("id"), "mix")) / F.when(F.col("id") % 2 == 0, 0.25).otherwise(1.0)).alias("key"))
    rows = [(r.key, r.bucket, r.id % 2) for r in keys.withColumn("bucket", mixing.bucket_of(F.col("key"), 64)).collect()]
    assert [b for _, b, _ in sorted(rows)] == sorted(b for _, b, _ in rows)
    for kind in (0, 1):
        held = Counter(b for _, b, k in rows if k == kind)
        assert max(held.values()) < 1.3 * len(mixing.WEIGHTS) / 64 * 20_000
