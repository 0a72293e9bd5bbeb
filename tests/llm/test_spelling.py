"""Permuterm rotations against comparing every pair of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from hearth.llm import spelling as S
from tests.conftest import SF_SMALL

ASCII = str.maketrans(S.UPPER, S.LOWER)


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counts(rows):
    c = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= 6 and n >= 5}


def brute(words):
    """{word: n} -> sorted (word, form, root, n, n_near, form_n); pairs that share no half are not one apart."""
    half = {}
    for w in words:
        for k in range(len(w) // 2 - 1, len(w) // 2 + 2):
            half.setdefault(("s", w[:k]), set()).add(w)
            half.setdefault(("e", w[-k:]), set()).add(w)
    nears = {w: set() for w in words}
    for ws in half.values():
        for a in ws:
            nears[a] |= {b for b in ws if a != b and one_apart(a, b)}
    form = {}
    for w, near in nears.items():
        best = min(near, key=lambda x: (-words[x], x.encode()), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(nears[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def told(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def words_frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def test_runs_of_equal_letters_count_once(spark):
    words = {"aaaaaa": 5, "aaaaaaa": 30, "aaaaaaaa": 200, "baaaaa": 5, "aabaaa": 7, "aaabaaa": 7, "abcdef": 100, "abcdf": 3, "abccdef": 9, "abcddef": 9}
    assert told(S.group(words_frame(spark, words))) == brute(words)


def test_small_alphabets_against_all_pairs(spark):
    rnd = random.Random(11)
    words = {}
    for _ in range(1500):
        words["".join(rnd.choice("abé") for _ in range(rnd.randint(4, 8)))] = int(5 ** rnd.uniform(1, 5))
    words |= {"x" * 300: 7, "x" * 301: 50, "x" * 150 + "y" + "x" * 150: 8}
    assert told(S.group(words_frame(spark, words))) == brute(words)


def test_chains_lead_to_the_last_form(spark):
    words = {"a" * k: 6 ** k for k in range(6, 20)}
    out = told(S.group(words_frame(spark, words)))
    assert out == brute(words)
    assert {r[2] for r in out} == {"a" * 19}
    with pytest.raises(ValueError):
        S.group(words_frame(spark, words), ratio=1)


def test_ranges_are_bounded_by_the_alphabet(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"hot{a}{b}word": 5 for a in letters for b in letters} | {"hotword": 6}
    most = S.rotations(words_frame(spark, words)).groupBy("prefix").count().agg(F.max("count")).first()[0]
    assert most <= len(letters) + 1
    assert told(S.group(words_frame(spark, words))) == brute(words)


DOCS = [(1, None), (2, ""), (3, "12 -- \n\t"), (4, "Straße ÜBER über Über strasseİ naïve naïve naïve naïve NAÏVE"), (None, "wörter " * 6 + "worter " * 30),
        (5, "letters " * 20_000 + "letter " * 6), (5, "letters " * 7), (6, "x" * 200_000 + " lettre" * 9), (7, "don't can×not Cafés cafés " * 40), (-8, "a\U0001f600bcdefg " * 12)]


def test_texts_of_all_kinds(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in ("word", "run", "id", "n", "i", "rank")])
    assert told(S.variants(df)) == brute(counts(DOCS))


def test_empty_table(spark):
    assert S.variants(spark.createDataFrame([], "doc_id long, text string")).isEmpty()


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = E.queries()["op11_spelling_variants"](spark, SF_SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert told(got) == brute(counts(rows))
