"""Elements of a page as an HTML parser finds them, in one linear pass.

The native helpers (``functions.html``) count tags of one name and so need well-formed markup.
Landed pages also hold commented-out cards, scripts that print markup, ``>`` in
attribute values and elements that are never closed; which of them end where is decided by the
stack of all open elements, so these pages are read by a small tokenizer in an
Arrow pass.  It keeps to the rules of the usual lenient HTML parsers:

* comments, and what ``script`` and ``style`` hold, are not markup;
* void elements (``br``, ``img``, ...) hold nothing;
* an opening tag closes the open element on top if it may not stand in it (``li`` after
  ``li``, a block after ``p``, table cells and rows);
* an end tag closes up to its element, unless a weightier one (``div``, table parts) is open
  inside it; without an open element of its name it is ignored;
* a tag that never ends takes the rest of the page with it; what is open at the end ends there.

Every token and every open element is handled once, and positions of open elements are
kept by name and by weight, so no page takes more than time in proportion to its length.

SURVEY IDs: P1, P10 (element boundaries).
"""

from __future__ import annotations

import html as _html
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hearth.session import ship_package

# Rules of HTML.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = ("script", "style")
BLOCKS = "address blockquote center dir div dl fieldset form h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul".split()
#: What an opening tag closes when it is the element on top.
CLOSES = {**{b: {"p"} for b in BLOCKS}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "option": {"option"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "tr": {"td", "th", "tr", "p"}, "tbody": {"td", "th", "tr", "thead", "tbody", "p"}}
#: Elements that an end tag of a lighter one can't close.
WEIGHT = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180, "table": 190, "head": 200, "body": 200, "html": 220}
LIGHT = 100

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_ATTR = re.compile(r"[\s/]*+([^\s=>/][^\s=>/]*+)(?:\s*+=\s*+(\"[^\"]*\"|'[^']*'|[^\s>]*+))?+")
_REST = re.compile(r"(?:[\s/]*+[^\s=>/][^\s=>/]*+(?:\s*+=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>]*+))?+|[\s/=])*+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}


@dataclass
class Element:
    name: str
    attrs: dict[str, str]
    start: int      # of what it holds
    end: int = -1


def attributes(text: str) -> dict[str, str]:
    """A tag's attributes, names in lower case, values unescaped; of repeated names the first counts."""
    out: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        value = m.group(2) or ""
        if value[:1] in ("'", '"') and len(value) > 1 and value[-1] == value[0]:
            value = value[1:-1]
        out.setdefault(m.group(1).lower(), _html.unescape(value))
    return out


def elements(page: str, wanted: Callable[[str, dict[str, str]], bool], names: frozenset[str] | None = None) -> list[Element]:
    """The elements that ``wanted`` says yes to, in the order they open; ``names`` are those worth asking about."""
    found: list[Element] = []
    stack: list[tuple[str, Element | None]] = []
    by_name: dict[str, list[int]] = defaultdict(list)
    by_weight: dict[int, list[int]] = {w: [] for w in set(WEIGHT.values())}

    def pop(at: int) -> None:
        name, element = stack.pop()
        by_name[name].pop()
        if name in WEIGHT:
            by_weight[WEIGHT[name]].pop()
        if element:
            element.end = at

    at = 0
    while (lt := page.find("<", at)) >= 0:
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            if end < 0:
                break
            at = end + 3
        elif page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            if end < 0:
                break
            at = end + 1
        elif page.startswith("</", lt):
            m = _NAME.match(page, lt + 2)
            end = page.find(">", lt)
            if end < 0:
                break
            at = end + 1
            if m and (places := by_name.get(name := m.group().lower())):
                mine = WEIGHT.get(name, LIGHT)
                if places[-1] >= max((p[-1] for w, p in by_weight.items() if w > mine and p), default=-1):
                    for _ in range(len(stack) - places[-1]):
                        pop(lt)
        else:
            m = _NAME.match(page, lt + 1)
            if not m:
                at = lt + 1
                continue
            name, rest = m.group().lower(), _REST.match(page, m.end())
            at = rest.end() + 1
            if rest.end() >= len(page):  # the tag never ends
                break
            while stack and stack[-1][0] in CLOSES.get(name, ()):
                pop(lt)
            element = None
            if names is None or name in names:
                attrs = attributes(rest.group())
                if wanted(name, attrs):
                    element = Element(name, attrs, at)
                    found.append(element)
            if name in VOID:
                if element:
                    element.end = at
                continue
            by_name[name].append(len(stack))
            if name in WEIGHT:
                by_weight[WEIGHT[name]].append(len(stack))
            stack.append((name, element))
            if name in RAW:
                end = _RAW_END[name].search(page, at)
                if not end:
                    break
                at = end.start()
    while stack:
        pop(len(page))
    return found


def has_class(attrs: dict[str, str], wanted: str) -> bool:
    """Whether the ``class`` value is ``wanted``, or holds it as one of its names."""
    own = attrs.get("class", "")
    return " ".join(own.split()) == wanted or wanted in own.split()


def _cards(class_text: str):
    def of(page: str) -> list[str]:
        return [page[e.start:e.end] for e in elements(page, lambda name, attrs: has_class(attrs, class_text))]
    return of


def gallery_items(page: str, class_text: str = "smallpic") -> list[dict] | None:
    """``(descr, src)`` of each ``li`` in the first ``ul`` of the class; null without such a list.

    ``src`` is that of the first ``img`` anywhere in the item (null if it has none).
    """
    found = elements(page, lambda name, attrs: name != "ul" or has_class(attrs, class_text), frozenset({"ul", "li", "img"}))
    block = next((e for e in found if e.name == "ul"), None)
    if block is None:
        return None
    inside = [e for e in found if block.start <= e.start <= block.end and e is not block]
    images = [e for e in inside if e.name == "img"]
    out, nth = [], 0
    for e in inside:
        if e.name == "li":  # items and images both come in the order they open
            while nth < len(images) and images[nth].start <= e.start:
                nth += 1
            image = images[nth] if nth < len(images) and images[nth].start <= e.end else None
            out.append({"descr": e.attrs.get("data-desc", ""), "src": image.attrs.get("src") if image else None})
    return out


def _rows_of(of, column: str, kind: pa.DataType, exploded: bool, html: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                got = [None if p is None else of(p) for p in part.column(html).to_pylist()]
                kept = [part.column(c) for c in keep]
                if exploded:
                    rows = [i for i, g in enumerate(got) for _ in g or ()]
                    kept = [c.take(pa.array(rows, pa.int32())) for c in kept]
                    more = [pa.array([j for g in got for j in range(len(g or ()))], pa.int32()), pa.array([x for g in got for x in g or ()], kind)]
                    yield pa.RecordBatch.from_arrays(kept + more, names=[*keep, "pos", column])
                else:
                    yield pa.RecordBatch.from_arrays(kept + [pa.array(got, kind)], names=[*keep, column])
    return run


def explode_cards(pages: DataFrame, class_text: str, html: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One row per element of the class: ``keep`` columns, ``pos`` (from 0 on the page) and ``card``, the markup it holds.

    Pages without text have none.
    """
    ship_package(pages.sparkSession)
    src = pages.select(*keep, html)
    out = T.StructType([*src.select(*keep).schema.fields, T.StructField("pos", T.IntegerType()), T.StructField("card", T.StringType())])
    return src.mapInArrow(_rows_of(_cards(class_text), "card", pa.string(), True, html, list(keep)), out)


def read_galleries(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("house_id", "link")) -> DataFrame:
    """``keep`` columns and ``items``, an array of ``(descr, src)``: null where a page has no gallery list or no text."""
    ship_package(pages.sparkSession)
    src = pages.select(*keep, html)
    item = T.StructType([T.StructField("descr", T.StringType()), T.StructField("src", T.StringType())])
    kind = pa.list_(pa.struct([("descr", pa.string()), ("src", pa.string())]))
    out = T.StructType([*src.select(*keep).schema.fields, T.StructField("items", T.ArrayType(item))])
    return src.mapInArrow(_rows_of(gallery_items, "items", kind, False, html, list(keep)), out)
