"""Token counts against the tokenizer library itself."""

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from hearth.llm import bpe
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
VOCABULARY = bpe.read_model(open(PATH, "rb").read())
COUNTER = bpe.Counter(VOCABULARY)

EDGES = ["", " ", "  ", "   x", "a", "a b  c   d" + " " * 40, "tab\tnew\nline\r\n", "<s> hi </s> <unk> <0x41> ▁x▁", "a\x00b", "été é 日本語 한국어 😀👩‍👩‍👧",
         "x" * 5000, "aaaaabaaaa" * 300, " " * 300, "▁" * 33 + "q", "﻿start", "İstanbul ß ﬁ ①", "https://a.b/c?d=e&f=%20#g", "\n\n\n\n", "word　wide no"]


@pytest.mark.parametrize("text", EDGES)
def test_edges(text):
    assert COUNTER.count(text) == len(LIBRARY.encode(text))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\teèaçthion▁.")), max_size=80))
def test_any_text(text):
    assert COUNTER.count(text) == len(LIBRARY.encode(text))


def test_cut_and_uncut_agree():
    rnd = random.Random(3)
    for _ in range(60):
        t = "".join(rnd.choice(" \nthersionalé日🙂") for _ in range(rnd.randint(1, 300)))
        assert COUNTER.count(t) == bpe.count_run((bpe.SPACE + t).replace(" ", bpe.SPACE), VOCABULARY.ranks)


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        bpe.read_model(b"")


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = {r.doc_id: (len(r.text.encode()), len(LIBRARY.encode(r.text))) for r in docs.collect()}
    assert {r.id: (r.n_bytes, r.n_tokens) for r in bpe.token_counts(docs, VOCABULARY).collect()} == want


def test_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (None, "a b", 5), (3, "same", 5), (3, "same", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(((r.id, r.n_bytes, r.n_tokens) for r in bpe.token_counts(df, VOCABULARY).collect()), key=str)
    assert got == sorted([(1, 0, 0), (2, 0, 0), (None, 3, 2), (3, 4, 1), (3, 4, 1)], key=str)
    assert bpe.token_counts(df.limit(0), VOCABULARY).count() == 0
