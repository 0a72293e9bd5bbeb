"""Deletion-neighbourhood line de-duplication against brute force."""

import random
import re

from pyspark.sql import functions as F

from hearth.llm import linededup
from tests.conftest import SF_SMALL


def apart(a, b):
    """Word edit distance, whole table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute(rows):
    """[(id, text)] with distinct ids -> {id: text}; every pair of lines is compared."""
    seen, out = [], {}
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if t is None:
            out[d] = None
            continue
        keep = []
        for line in t.split("\n"):
            w = tuple(x for x in re.split(r"[\x20\x09-\x0D]+", line) if x)
            dup = len(w) >= 1 and any(
                w == s or (len(w) >= 5 and len(s) >= 5 and abs(len(w) - len(s)) <= 1 and (set(w[:2]) & set(s[:2]) or set(w[-2:]) & set(s[-2:])) and apart(w, s) <= 1)
                for s in seen)
            seen.append(w)
            if not dup:
                keep.append(line)
        out[d] = "\n".join(keep)
    return out


def rows_with_edits():
    rnd = random.Random(2)
    line = [f"w{rnd.randint(0, 9)}" for _ in range(14)]
    cut = lambda i: line[:i] + line[i + 1:]
    put = lambda i, w: line[:i] + [w] + line[i:]
    swap = lambda i, w: line[:i] + [w] + line[i + 1:]
    some = [line, cut(0), cut(13), cut(6), put(0, "n"), put(14, "n"), put(7, "n"), swap(0, "s"), swap(13, "s"), swap(5, "s"),
            swap(5, "s")[:9] + ["far"] + swap(5, "s")[10:], put(3, "n")[:-1], ["a"] * 12, ["a"] * 13, ["a"] * 14, ["a", "b"] * 6, ["b", "a"] * 6]
    rnd.shuffle(some)
    rows = [(100 - i, "head\n" + " ".join(w) + "\n\nshort one") for i, w in enumerate(some)]
    rows += [(1, None), (2, ""), (3, "one two three four\none two three four"), (4, "one two three four five\none  two\tthree four five"),
             (5, "x " * 30000), (6, "only this line has these words\nonly this line has these words"), (7, "only this line has these words"),
             (200, "Long " + " ".join(f"t{i}" for i in range(3000))), (201, "Long " + " ".join(f"t{i}" for i in range(3000) if i != 1500))]
    return rows


def test_matches_brute_force_on_edits(spark):
    rows = rows_with_edits()
    df = spark.createDataFrame([(d, t, "x", 7) for d, t in rows], "doc_id long, text string, row string, gone int").repartition(4)
    got = linededup.dedup_lines(df)
    assert got.columns == [*df.columns, "__gone"]
    assert {r.doc_id: r.text for r in got.collect()} == brute(rows)


def test_matches_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter(F.length("text") < 3000)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()} == brute(rows)


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f\nrest"), (None, "g h i j k"), (1, "g h i j k")],
                               "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in linededup.dedup_lines(df).collect()), key=str)
    assert got == sorted([(1, "a b c d e f"), (1, "a b c d e f"), (None, "rest"), (None, ""), (1, "g h i j k")], key=str)
    kept = sorted(((r.doc_id, r.text) for r in linededup.keep_rest(df).collect()), key=str)
    assert kept == sorted([(1, "a b c d e f"), (1, "a b c d e f"), (None, "rest"), (1, "g h i j k")], key=str)


def plain_rest(rows):
    """[(id, text)] with distinct ids -> {id: text} as the pipeline keeps it; every pair of lines is compared."""
    seen, out = [], {}
    for d, t in sorted(rows):
        keep = []
        for line in t.split("\n"):
            w = tuple(x for x in re.split(r"[\x20\x09-\x0D]+", line) if x)
            if not w or not any(w == s or (min(len(w), len(s)) >= 5 and abs(len(w) - len(s)) <= 1 and apart(w, s) <= 1) for s in seen):
                keep.append(line)
            seen.append(w)
        if not t.strip() or "".join(keep).strip():
            out[d] = "\n".join(keep)
    return out


def test_the_pipeline_compares_short_lines(spark):
    rnd = random.Random(5)
    rows = [(1, "All rights reserved.\n\nhome"), (2, "All  rights\treserved.\n\nother"), (3, "home"), (4, " \n\n"), (5, ""),
            (6, "a b c d\na b c e"), (7, "one two three four five\none two three four six"), (8, "p q r s t u v w x\np q r s t u v w x y"),
            (9, "k l m n o\nk l m n o p\nk l m n")]
    rows += [(20 + i, "\n".join(" ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 11))) for _ in range(5))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.text for r in linededup.keep_rest(df).collect()}
    assert got == plain_rest(rows)
    assert 3 not in got and got[2] == "\nother" and got[7] == "one two three four five" and got[8] == "p q r s t u v w x"


def test_texts_found_again_by_a_shuffle(spark, monkeypatch):
    """Beyond the broadcast bound the texts of candidate lines are found by a semi-join; the answer is the same."""
    monkeypatch.setattr(linededup, "BROADCAST_ROWS", 0)
    rows = rows_with_edits()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.text for r in linededup.dedup_lines(df).collect()} == brute(rows)


def test_a_very_long_line_costs_as_much_as_it_has_words(spark):
    import time

    def seconds(n):
        words = [f"t{i}" for i in range(n)]
        rows = [(1, " ".join(words)), (2, " ".join(words[:n // 2] + words[n // 2 + 1:])), (3, " ".join(words[:n // 3] + ["x"] + words[n // 3 + 1:])), (4, "other line\n" + " ".join(words))]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        t = time.perf_counter()
        got = {r.doc_id: r.text for r in linededup.dedup_lines(df).collect()}
        assert got == {1: rows[0][1], 2: "", 3: "", 4: "other line"}
        return time.perf_counter() - t
    small = seconds(10_000)
    assert seconds(100_000) <= 10 * small + 10


def test_running_hashes_at_piece_borders(spark):
    df = spark.createDataFrame([(list(range(100, 100 + n)),) for n in (1, 63, 64, 65, 128, 129, 200)], "h array<long>")
    r = df.select("h", linededup._running(F.col("h")).alias("r")).select("h", F.transform(F.sequence(F.lit(0), F.size("h")), lambda i: linededup._upto("r", i)).alias("got"))
    for row in r.collect():
        want = [0]
        for x in row.h:
            want.append(want[-1] ^ x)
        assert row.got == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert linededup.dedup_lines(df).count() == 0


def test_one_word_apart(spark):
    rnd = random.Random(1)
    pairs = [([rnd.choice("ab") for _ in range(rnd.randint(1, 5))], [rnd.choice("ab") for _ in range(rnd.randint(1, 5))]) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>")
    for r in df.select("a", "b", linededup.one_word_apart("a", "b").alias("near")).collect():
        assert r.near == (apart(r.a, r.b) <= 1), r
