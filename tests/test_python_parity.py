"""The text helpers against Python itself on generated strings.

``re.findall(p, s)[0].strip()`` (or '-') is the specification of a field, so the
reference's own field patterns are run through Python's ``re`` and through
``first_match`` on card-like strings with tags, quotes, newlines and '\\r'.
"""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from hearth.functions import text
from hearth.operators import extract

PATTERNS = [extract.ID_RE, extract.TITLE_RE, extract.COMMUNITY_RE, extract.POSITION_RE,
            extract.TAX_RE, extract.TOTAL_PRICE_RE, extract.UNIT_PRICE_RE, extract.FACTS_RE,
            extract.RESULT_COUNT_RE]

FRAGMENTS = ['data-housecode="', '"', 'target="_blank">', "</a>", "<!--", "xiaoqu", "<a href",
             'class="address">', 'class="taxfree">', "</span>", 'data-price="', "<i>万",
             'class="totalPrice totalPrice2"><i> </i><span class="">', 'class="houseIcon"></span>',
             "</div>", "共找到<span> ", " </span>套", "二手房", " ", "\n", "\r", "　", "|", "12", "3.5",
             "南北", "x", "-"]


def py_first(p, s):
    found = re.findall(p, s)
    return found[0].strip() if found else "-"


cards = st.lists(st.sampled_from(FRAGMENTS), max_size=25).map("".join)


@settings(max_examples=25, deadline=None)
@given(st.lists(cards, min_size=1, max_size=12))
def test_first_match_is_python_findall(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    cols = [text.first_match("s", p).alias(f"m{k}") for k, p in enumerate(PATTERNS)]
    rows = df.select("i", *cols).orderBy("i").collect()
    for r, v in zip(rows, values):
        assert [r[f"m{k}"] for k in range(len(PATTERNS))] == [py_first(p, v) for p in PATTERNS], v


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("a|b ,，.\n")), max_size=15), min_size=1, max_size=15))
def test_split_and_title_clean_are_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    rows = df.select("i", text.split_parts("s", "|").alias("parts"),
                     text.title_clean("s").alias("t")).orderBy("i").collect()
    for r, v in zip(rows, values):
        assert list(r.parts) == v.split("|")
        assert not set(r.t) & set(",， ") and len(r.t) <= len(v)


def test_title_clean_golden(spark):
    pairs = [(" 南北,通透 两居 ", "南北-通透-两居"), ("a，b", "a-b"), ("", ""), ("\n x,, y\t", "x---y"), ("　全角　", "全角")]
    df = spark.createDataFrame(pairs, "s string, t string")
    assert all(r.got == r.t for r in df.select("t", text.title_clean("s").alias("got")).collect())
