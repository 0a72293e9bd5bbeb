"""b-bit MinHash near duplicates against brute force over all pairs."""

import random
import re

import numpy as np

from hearth.llm import graph, hashing, minhash
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, kept string"


def sh(t):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """[(id, text)] -> sorted [(id, n, component, kept)]."""
    s = [sh(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(s[i] & s[j])
            if both and 100 * both >= 75 * len(s[i] | s[j]):
                root[top(i)] = top(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None] if s[i] else [d]
        c = min([x for x in ids if x is not None], default=None)
        out.append((d, len(s[i]), c, c == d))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def edge_rows():
    rnd = random.Random(5)
    words = [rnd.choice("abcdefgh") * rnd.randint(1, 4) + str(rnd.randint(0, 60)) for _ in range(400)]
    base = " ".join(words)
    near = [" ".join(words[:i] + ["x%d" % i] + words[i + 1:]) for i in range(0, 60, 2)]
    chain, cur = [], list(words[:120])
    for i in range(12):  # each links with its neighbours, the ends not with one another
        cur = cur[8:] + ["c%d_%d" % (i, j) for j in range(8)]
        chain.append(" ".join(cur))
    rows = [(None, base), (5, base), (5, base), (3, base.upper()), (3, "other words that are here now"),
            (9, ""), (9, ""), (10, None), (11, " \t\n"), (12, "one two"), (13, "One\ttwo"), (14, "one two three"),
            (None, ""), (None, "lone null id row with several words"), (15, "été x a b c d e"), (16, "w" * 100_000)]
    rows += [(100 + i, t) for i, t in enumerate(near)] + [(200 + i, t) for i, t in enumerate(chain)]
    return rows


def test_matches_brute_force_on_edges(spark):
    rows = edge_rows()
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    assert result(minhash.near_duplicates(df)) == brute(rows)


def test_matches_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(minhash.near_duplicates(docs)) == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert minhash.near_duplicates(df).count() == 0
    assert minhash.keep_one(df).count() == 0


def test_keep_one_of_each_group(spark):
    rows = edge_rows()
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    got = minhash.keep_one(df)
    assert got.columns == df.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    want = brute(rows)
    groups = {(c, n) for d, n, c, k in want if n}
    assert len([1 for d, t in kept if sh(t)]) == len({c for c, _ in groups} | set()) + 1  # two groups share id 3
    assert len([1 for d, t in kept if not sh(t)]) == 5


def test_shingle_hashes_follow_the_words():
    t = "a  b\tc d é\x0bf\x85g h"
    raw = t.encode().lower()
    assert hashing.word_hashes(raw).size == len(raw.split())
    assert hashing.shingles(raw, 5).size == len(sh(t))
    assert (hashing.shingles(b"a b c d e f", 5) == hashing.shingles(b"\n a\tb c  d e f ", 5)).all()


def test_long_text_in_pieces(monkeypatch):
    raw = (" ".join("w%d" % (i % 700) for i in range(5000)) + " " + "z" * 9000).encode()
    whole = hashing.word_hashes(raw)
    monkeypatch.setattr(hashing, "_PIECE", 1000)
    assert (hashing.word_hashes(raw) == whole).all()


def test_estimate_is_near_the_similarity(spark):
    rnd = np.random.default_rng(3)
    x = rnd.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.unique(x[:2400]), np.unique(x[300:])
    true = 2100 / 3000
    df = spark.createDataFrame([(minhash.signature(a)[1].tolist(), minhash.signature(b)[1].tolist())], "a array<long>, b array<long>")
    assert abs(df.select(minhash.estimate(df.a, df.b)).first()[0] - true) < 0.15


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (9, 3), (20, 21), (21, 20), (5, 5)] + [(100, 100 + i) for i in range(1, 50)]
                              + [(300 + i, 301 + i) for i in range(40)], "a long, b long")
    got = dict((r.node, r.root) for r in graph.components(e).collect())
    assert got[9] == 1 and got[21] == 20 and got[149] == 100 and got[340] == 300 and 5 not in got
