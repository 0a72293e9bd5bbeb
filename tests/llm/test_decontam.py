"""Greedy string tiling against a plain version, and planted leaks."""

import random

from hearth.llm import decontam
from tests.conftest import SF_SMALL


def plain_tiles(a, b, least):
    """Greedy string tiling as defined: all common unmarked runs, the longest marked first."""
    fa, fb, out = [True] * len(a), [True] * len(b), []
    while True:
        best, hits = 0, []
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and fa[i + n] and fb[j + n]:
                    n += 1
                if n > best:
                    best, hits = n, []
                if n == best:
                    hits.append((i, j))
        if best < least:
            return out
        for i, j in hits:
            if all(fa[i:i + best]) and all(fb[j:j + best]):
                fa[i:i + best] = fb[j:j + best] = [False] * best
                out.append((i, j, best))


def plain_leaks(docs, items, least=5, cover=decontam.LEAST_COVER):
    out = []
    for d, t in docs:
        for i, u in items:
            a, b = decontam.words_of(u), decontam.words_of(t)
            c = sum(x[2] for x in plain_tiles(a, b, min(least, len(a)))) if a else 0
            if a and c >= (cover if len(a) >= least else 1) * len(a):
                out.append((d, i, len(a), c))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.id, r.item_id, r.item_words, r.covered) for r in df.collect()), key=str)


def test_tiles_match_the_definition():
    rnd = random.Random(4)
    for _ in range(150):
        a, b = ([rnd.randint(1, 3) for _ in range(rnd.randint(0, 25))] for _ in range(2))
        assert decontam.greedy_tiles(a, b, 3) == plain_tiles(a, b, 3)


def test_runs_of_one_word_take_linear_memory():
    import time
    t = time.perf_counter()
    tiles = decontam.greedy_tiles([7] * 3000 + [1, 2], [7] * 1000 + [9] + [7] * 30_000, 5)
    assert tiles == [(0, 1001, 3000)]
    assert decontam.greedy_tiles([7] * 3000, ([7] * 50 + [9]) * 300, 5) == [(50 * i, 51 * i, 50) for i in range(60)]
    assert time.perf_counter() - t < 60


def planted():
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(3))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([4, 5, 12, 30, 60, 31])] + [(50, None), (51, ""), (None, " ".join(word() for _ in range(9)))]
    noise = lambda n: " ".join(word() for _ in range(n))
    w = items[4][1].split()
    docs = [(1, noise(40) + " " + items[3][1].upper() + "! " + noise(10)), (2, " ".join(w[40:] + [noise(3)] + w[20:40] + [noise(2)] + w[:20])),
            (3, " ".join(w[:30])), (14, " ".join(w[:29])), (4, " ".join(w[:37])), (5, noise(500)), (6, items[0][1]), (7, items[1][1]), (8, None), (9, ""), (None, items[2][1]),
            (10, (items[2][1] + " ") * 30), (10, (items[2][1] + " ") * 30), (11, " ".join(" ".join([x, "zz"]) for x in w)), (12, noise(3000) + " " + items[5][1]), (13, items[8][1])]
    return docs, items


def test_planted_and_reordered(spark):
    docs, items = planted()
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    want = plain_leaks(docs, items)
    assert {x[0] for x in want} == {1, 2, 3, 4, 6, 7, None, 10, 12, 13}
    assert got(decontam.leaks(d, b)) == want
    assert got(decontam.leaks(d, b, block_words=20)) == want  # many blocks
    clean = decontam.keep_clean(d, b)
    assert clean.columns == d.columns and sorted(r.doc_id for r in clean.collect()) == [5, 8, 9, 11, 14]


def test_short_items_and_unspaced_scripts(spark):
    items = [(1, "What is it?"), (2, "Forty-two"), (3, "這個故事發生在很久以前的一個小鎮上"), (4, "法國的首都"), (5, "!?"), (6, "what is it"), (7, "ราคาเท่าไร")]
    docs = [(1, "so, WHAT IS IT then"), (2, "what it is"), (3, "forty, and two; forty two"), (4, "從前，這個故事發生在很久以前的地方。在很久"), (5, "法國的首都是巴黎"),
            (6, "首都的法國"), (7, "what is"), (8, "it"), (9, "ถามว่าราคาเท่าไรครับ"), (10, "what is it " * 50)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = plain_leaks(docs, items)
    assert {x[:2] for x in want} == {(1, 1), (1, 6), (3, 2), (4, 3), (5, 4), (9, 7), (10, 1), (10, 6)}
    assert got(decontam.leaks(d, b)) == want and got(decontam.leaks(d, b, block_words=4)) == want
    assert sorted(r.doc_id for r in decontam.keep_clean(d, b).collect()) == [2, 6, 7, 8]


def test_whole_documents(spark):
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text) < 2500]
    short = spark.createDataFrame(rows, "doc_id long, text string")
    own = [(r.item_id, r.text) for r in items.collect()]
    near = [(d, t) for d, t in rows if any(" ".join(decontam.words_of(u)[:5]) in " ".join(decontam.words_of(t)) for _, u in own)]
    leaks = got(decontam.leaks(short, items))
    assert leaks and [x for x in leaks if x[0] in {d for d, _ in near}] == plain_leaks(near, own)


def test_empty_tables(spark):
    d, b = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    full = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert decontam.leaks(full, b).count() == 0 and decontam.leaks(d, b).count() == 0
    assert decontam.keep_clean(full, b).count() == 1
