"""Vertical scans against scoring every row."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from hearth.llm import negatives as N
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, scale=256):
    """[(vec_id, embedding, label)] -> sorted result rows, by all inner products."""
    vecs = set()
    for i, e, lab in rows:
        if i is None or lab is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        vecs.add((i, (lab + 1) % 10 if i % 7 == 0 else lab, tuple(math.floor(scale * float(np.float32(x))) for x in e)))
    out = []
    for i, lab, v in vecs:
        if i % every:
            continue
        score = sorted((-sum(x * y for x, y in zip(v, w)), j, m) for j, m, w in vecs if j != i or m != lab)
        for ps, p, _ in [s for s in score if s[2] == lab and s[1] != i][:5]:
            fit = [s for s in score if s[2] != lab and 30 * -ps <= 100 * -s[0] <= 90 * -ps]
            out += [(i, p, r + 1, s[1], -ps, -s[0]) for r, s in enumerate(fit[:10])]
    return sorted(out)


def told(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def mined(df, every=100):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return N.mine(N.usable(df, label=label), F.col("id") % every == 0)


def clustered(n, dim=16, labels=10, seed=1, skew=False):
    rnd = np.random.default_rng(seed)
    centre = rnd.normal(size=(labels, dim))
    lab = np.where(rnd.random(n) < 0.4, 0, rnd.integers(0, labels, n)) if skew else rnd.integers(0, labels, n)
    x = centre[lab] + rnd.normal(size=(n, dim)) * 0.8
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    return [(int(i), [float(y) for y in x[i]], int(lab[i])) for i in range(n)]


def test_clusters_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "PACK", 3)
    monkeypatch.setattr(N.blocks, "__defaults__", (40,))
    rows = clustered(700, skew=True)
    assert told(mined(spark.createDataFrame(rows, SCHEMA), 20)) == brute(rows, 20)


def test_ties_nulls_repeats_and_odd_lengths(spark):
    rnd = random.Random(3)
    rows = [(i, [float(rnd.randint(-1, 2)) / 256 for _ in range(4)], rnd.randint(0, 2)) for i in range(300)]
    rows += [(300, [0.01] * 4, None), (400, None, 1), (500, [0.01, None, 0.02, 0.1], 1), (600, [float("nan")] * 4, 1), (601, [float("inf")] * 4, 1),
             (None, [0.01] * 4, 1), (700, [], 1), (701, [0.01], 2), (800, [0.01] * 9, 0), (801, [0.02] * 9, 1), (900, [0.01] * 4, 77), (-100, [0.01] * 4, 1), (-7, [0.01] * 4, 9)]
    rows += rows[:50] + [(5, [0.2] * 4, 1), (100, [0.3] * 4, 2)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("id", "vec", "akey", "score", "pack")])
    assert told(mined(df)) == brute(rows)


def test_one_vector_shared_by_most_rows(spark):
    rows = [(i, [0.1, -0.2, 0.3], i % 3) for i in range(2000)] + clustered(400, 3)[300:]
    assert told(mined(spark.createDataFrame(rows, SCHEMA), 500)) == brute(rows, 500)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(x) for x in np.random.default_rng(i).integers(-2 ** 20, 2 ** 20, 3)], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert told(mined(df, 20)) == brute(rows, 20)
    far = [(i, [2.0 ** 22 + 0.5 * i, -3.0, 5.0], i % 2) for i in range(60)]  # products beyond 2^53
    assert told(mined(spark.createDataFrame(far, SCHEMA), 20)) == brute(far, 20)


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mined(df).isEmpty()
    assert mined(spark.createDataFrame([(1, [0.1], 1)], SCHEMA)).isEmpty()
    assert mined(spark.createDataFrame([(100, [0.1], 1)], SCHEMA)).isEmpty()


def test_columns_are_read_by_magnitude_and_candidates_leave_early():
    """The scan reads an anchor's largest components first and drops rows it need not score."""
    rnd = np.random.default_rng(0)
    cols = rnd.integers(-5, 6, (32, 4000))
    cols[7] = rnd.integers(-200, 201, 4000)
    anchor = np.ones(32, np.int64)
    anchor[7] = 100
    seen = []

    def stay(least, most):
        seen.append(least.size)
        return N._best(5)(least, most)
    places, scores = N.scan(anchor, cols, cols.min(axis=1), cols.max(axis=1), stay)
    exact = anchor @ cols
    assert seen[0] == 4000 and seen[1] < 200
    assert sorted(scores)[-5:] == sorted(exact)[-5:] and (exact[places] == scores).all()


def test_a_hot_label_is_cut_into_blocks(spark):
    rows = [(i, [0.1 * (i % 9)], 0 if i % 3 else i % 10) for i in range(3000)]
    got = N.blocks(N.usable(spark.createDataFrame(rows, SCHEMA)), 100).select("label", "n").collect()
    assert sum(r.n for r in got) == 3000 and max(r.n for r in got) <= 100


@pytest.mark.parametrize("score,want", [(100, (30, 90)), (1, (1, 0)), (0, (0, 0)), (-100, (-30, -90)), (7, (3, 6))])
def test_windows(score, want):
    assert N.window(score, 30, 90) == want


def test_query_matches_sql(spark):
    name = "op13_hard_negatives"
    r = compare(spark, duck(SF_SMALL), SF_SMALL, name, E.queries()[name], E.oracle_sql()[name])
    assert r["ok"], r
