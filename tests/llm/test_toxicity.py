"""The chain against enumeration, held-out accuracy on documents, and edge cases."""

import itertools
from math import exp
from zlib import crc32

import numpy as np
import pytest

from hearth.llm import toxicity
from tests.conftest import SF_ORACLE


def random_chain(seed):
    rnd = np.random.default_rng(seed)
    return toxicity.Chain(rnd.normal(size=toxicity.SLOTS), -0.3, 0.4, rnd.normal(size=(2, 2)))


def test_marginals_match_enumeration():
    for seed in range(20):
        m, rnd = random_chain(seed), np.random.default_rng(seed)
        n = int(rnd.integers(1, 7))
        e = rnd.normal(size=n)
        total, one = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            s = m.start * y[0] + sum(a * b for a, b in zip(e, y)) + sum(m.move[a, b] for a, b in zip(y, y[1:]))
            total += exp(s)
            one += np.array(y) * exp(s)
        odds, mask = np.ones((8, 1)), np.zeros((8, 1), bool)
        odds[:n, 0], mask[:n, 0] = np.exp(e), True
        assert np.allclose(m.marginals(odds, mask)[:n, 0], one / total)
        fwd, bwd = m.odds(odds, mask)
        assert abs(m.pairs(fwd, bwd, odds, mask).sum() - (n - 1)) < 1e-9


def plain_marginals(m, words):
    """Forward-backward over one whole chain, place by place, in logarithms."""
    n, e = len(words), [m.emission(w) for w in words]
    own = np.array([[0.0, np.log(x)] for x in e])
    fwd, bwd = np.zeros((n, 2)), np.zeros((n, 2))
    fwd[0] = own[0] + [0, m.start]
    for i in range(1, n):
        fwd[i] = own[i] + np.logaddexp.reduce(fwd[i - 1][:, None] + m.move, axis=0)
    for i in range(n - 2, -1, -1):
        bwd[i] = np.logaddexp.reduce(m.move + (own[i + 1] + bwd[i + 1])[None, :], axis=1)
    both = fwd + bwd
    return np.exp(both[:, 1] - np.logaddexp(both[:, 0], both[:, 1]))


def test_long_texts_score_as_one_chain():
    """Whatever the length, also where a piece ends, and whichever texts stand beside."""
    for seed in range(4):
        m = random_chain(seed)
        m.move *= 3  # sticky enough for a cut to show
        words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(1000)]
        lengths = [1000, 0, 1, toxicity.CHAIN - 1, toxicity.CHAIN, toxicity.CHAIN + 1, 2 * toxicity.CHAIN, 333]
        got = toxicity.score_texts(m, toxicity._Scores(m), [" ".join(words[:n]) for n in lengths])
        for n, p in zip(lengths, got):
            assert p.size == n and (n == 0 or np.allclose(p, plain_marginals(m, words[:n]), atol=1e-9))


def test_words_far_apart_from_any_doubt_stay_finite():
    m = random_chain(3)
    m.weight *= 30
    m.__post_init__()
    p = toxicity.score_texts(m, toxicity._Scores(m), [" ".join(f"x{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(3000))])[0]
    assert p.size == 3000 and np.isfinite(p).all() and ((0 <= p) & (p <= 1)).all()


def test_offsets_are_those_of_the_text(spark):
    d, labels = small(spark)
    text = "\u0130\u0130 Zzgrot here"  # lower-casing makes this text longer
    got = toxicity.score(spark.createDataFrame([(1, text, "")], d.schema), toxicity.fit(d, labels)).first()
    assert [text[s.begin:s.end] for s in got.spans] == ["Zzgrot"]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_ORACLE}/{t}.parquet") for t in ("documents", "labels"))
    out = {r.id: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.values())
    held = [(r.doc_id, r.toxic) for r in labels.collect() if crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(out[d].predicted == y for d, y in held) >= 0.9 * len(held)


def small(spark):
    bad, good = "you are a zzgrot and a zzgrot{} indeed", "you are a quiet text and a number {} indeed"
    rows = [(i, (bad if i % 3 == 0 else good).format("abcdefghij"[i % 10] * (i % 7 + 1)) + " " + " ".join(f"{chr(97 + (i * k) % 26)}{chr(97 + k % 26)}{chr(97 + i % 26)}" for k in range(20))) for i in range(120)]
    labels = [(i, int(i % 3 == 0)) for i in range(120)] + [(7, None), (None, 1)]
    d = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, score string")
    return d, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_edges(spark):
    d, labels = small(spark)
    model = toxicity.fit(d, labels)
    t = "Fine words. ZZGROT here"
    more = spark.createDataFrame([(500, None, ""), (501, "", ""), (502, "...", ""), (None, t, ""), (503, t, ""), (503, t, ""), (504, "quiet text " * 20000, "")], d.schema)
    got = toxicity.score(more, model).collect()
    by = {r.id: r for r in got}
    assert len(got) == 7 and all(by[i].score == 0 and by[i].predicted == 0 for i in (500, 501, 502))
    assert by[None].predicted == by[503].predicted == 1 and [tuple(s) for s in by[503].spans] == [(12, 18)]
    assert by[504].predicted == 0
    clean = toxicity.keep_clean(d.unionByName(more), labels)
    assert clean.columns == d.columns and {r.doc_id for r in clean.collect()} == {i for i in range(120) if i % 3} | {500, 501, 502, 504}


def test_one_long_text_costs_only_itself(spark):
    d, labels = small(spark)
    whole = toxicity.sample(d, labels, "doc_id", "text", "toxic")
    long = spark.createDataFrame([(i, "very long " * 5000, "") for i in range(1000, 1040)], d.schema)
    more = labels.unionByName(spark.createDataFrame([(i, i % 2) for i in range(1000, 1040)], labels.schema))
    assert sorted(toxicity.sample(d.unionByName(long), more, "doc_id", "text", "toxic", chars=40_000)) == sorted(whole)
    few = toxicity.sample(d.unionByName(long), more, "doc_id", "text", "toxic", chars=3000)
    assert 2000 < sum(len(t) for t, _ in few) <= 3000 and abs(sum(2 * y - 1 for _, y in few)) <= 2
    with pytest.raises(ValueError, match="1"):
        toxicity.sample(d.filter("doc_id % 3 > 0").unionByName(long), more.filter("toxic = 0 or doc_id >= 1000"), "doc_id", "text", "toxic", chars=40_000)
    with pytest.raises(ValueError, match="only labels"):
        toxicity.sample(d.filter("doc_id % 3 > 0"), labels, "doc_id", "text", "toxic")
    assert toxicity.sample(d.limit(0), labels, "doc_id", "text", "toxic") == []


def test_empty_tables(spark):
    d, labels = small(spark)
    assert toxicity.score(d.limit(0), toxicity.fit(d, labels)).count() == 0
    model = toxicity.fit(d, labels.limit(0))
    assert toxicity.score(d, model).filter("predicted = 1").count() == 0
