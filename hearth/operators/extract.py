"""Landed listing pages -> typed listing rows, with a reject table beside them.

One narrow stage: split each page into cards (``posexplode``), pull fields with
regular expressions, type them, and label every card that cannot become a
listing with the first reason it fails.  No shuffle until the caller writes.

SURVEY IDs: S1, S3, S4, L5, P1-P9, P16, A5.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.session import spread
from hearth.functions import markup
from hearth.functions.html import element_text
from hearth.functions.text import (
    FULLWIDTH_DIGITS, col_, first_match, part, py_strip, required_match, split_parts, strict_double,
    title_clean,
)

# Markup patterns of a listing page (regular expressions).
CARD_MARKER = r"""<[a-zA-Z][a-zA-Z0-9]*\s(?:[^>]*\s)?class\s*=\s*(?:"info clear"|'info clear')[^>]*>"""
CARD_CLASS = "info clear"
CARD_TAG = r"^<([a-zA-Z][a-zA-Z0-9]*)"
ID_RE = r'data-housecode="(.*?)"'
TITLE_RE = r'target="_blank">(.*?)</a><!--'
COMMUNITY_RE = r'xiaoqu.*?target="_blank">(.*?)</a>'
POSITION_RE = r'<a href.*?target="_blank">(.*?)</a>.*?class="address">'
TAX_RE = r'class="taxfree">(.*?)</span>'
TOTAL_PRICE_RE = r'class="totalPrice totalPrice2"><i> </i><span class="">(.*?)</span><i>万'
UNIT_PRICE_RE = r'data-price="(.*?)"'
FACTS_RE = r'class="houseIcon"></span>(.*?)</div>'
FACTS_SEP = "|"
SIZE_UNIT = "平米"
RESULT_COUNT_RE = r"共找到<span> (.*?) </span>套.*二手房"
DISTRICT_IN_URL_RE = r"/([^/]+?)(?:/pg[0-9]+)?/?$"

# Paging of a district's result list.
LISTINGS_PER_PAGE = 30
LISTING_CAP = 3000

# Facts in the order they appear, ' | ' separated; extras are ignored.
FACT_COLUMNS = ["house_type", "house_size", "direction", "fitment", "level", "build_type"]

# Reject reasons, in the order a card is checked.
MISSING_ID, BAD_NUMBER, MISSING_FACTS, SHORT_FACTS, BAD_ID = (
    "missing_id", "bad_number", "missing_facts", "short_facts", "bad_id")

SEQ_STRIDE = 100_000  # seq = page_id * SEQ_STRIDE + card position


@dataclass(frozen=True)
class Site:
    """Where listing and page links point; ``{city}`` is filled in."""
    root: str = "https://{city}.example.com/ershoufang"
    city: str = "hd"

    @property
    def base(self) -> str:
        return self.root.format(city=self.city).rstrip("/")


def explode_cards(pages: DataFrame, html: str = "html", marker: str = CARD_MARKER,
                  card_end: str | None = None, keep=("page_id",)) -> DataFrame:
    """One row per card: the inside of each element whose opening tag is ``marker``.

    A page is split before each opening tag; a card ends where its own element closes
    (tags of its name are counted), so lists and blocks may nest in it.
    ``card_end`` instead cuts at the first such text.  ``pos`` is the card's 0-based
    position on the page.
    """
    arr = F.split(F.col(html), f"(?={marker})", -1)
    has = F.filter(arr, lambda x: x.rlike("^" + marker))
    cards = pages.select(*keep, F.posexplode(has).alias("pos", "_card"))
    rest = F.regexp_replace("_card", "^" + marker, "")
    if card_end:
        return cards.select(*keep, "pos", F.substring_index(rest, card_end, 1).alias("card"))
    return cards.select(*keep, "pos", element_text(rest, F.regexp_extract("_card", CARD_TAG, 1)).alias("card"))


def first_reason(checks: list[tuple[str, Column]]) -> Column:
    """The name of the first check whose 'bad' condition holds, else null."""
    out = None
    for name, bad in checks:
        cond = F.coalesce(bad, F.lit(False))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def parse_cards(cards: DataFrame, district: Column, site: Site = Site()) -> DataFrame:
    """Card HTML -> listing fields plus ``reject_reason`` (null for a good card).

    Two projections: the regular expressions run once per card in the first,
    and typing and checks read their results in the second (Catalyst keeps the
    projections apart because each raw field is used several times).
    """
    c = F.col("card")
    raw = cards.select(
        "*",
        district.alias("_district"),
        required_match(c, ID_RE).alias("_id"),
        split_parts(required_match(c, FACTS_RE, strip=True), FACTS_SEP).alias("_facts"),
        first_match(c, TITLE_RE).alias("_title"),
        first_match(c, COMMUNITY_RE).alias("_community"),
        first_match(c, POSITION_RE).alias("_position"),
        first_match(c, TAX_RE).alias("_tax"),
        strict_double(first_match(c, TOTAL_PRICE_RE)).alias("_total"),
        strict_double(first_match(c, UNIT_PRICE_RE)).alias("_unit"),
    )
    facts = F.col("_facts")
    typed = raw.select(
        "*",
        F.col("_id").try_cast("bigint").alias("_house_id"),
        strict_double(F.replace(F.get(facts, 1), F.lit(SIZE_UNIT), F.lit(""))).alias("_size"))
    reason = first_reason([
        (MISSING_ID, F.col("_id").isNull()),
        (BAD_NUMBER, F.col("_total").isNull() | F.col("_unit").isNull()),
        (MISSING_FACTS, facts.isNull()),
        (SHORT_FACTS, F.size(facts) < 2),
        (BAD_NUMBER, F.col("_size").isNull()),
        (SHORT_FACTS, F.size(facts) < len(FACT_COLUMNS)),
        (BAD_ID, F.col("_house_id").isNull()),
    ])
    out = [
        *[F.col(c) for c in cards.columns],
        F.col("_house_id").alias("house_id"),
        title_clean(F.col("_title")).alias("title"),
        F.col("_district").alias("district"),
        F.col("_community").alias("community"),
        F.col("_position").alias("position"),
        F.col("_tax").alias("tax"),
        F.col("_total").alias("total_price"),
        F.col("_unit").alias("unit_price"),
        F.format_string("%s/%s.html", F.lit(site.base), F.col("_id")).alias("link"),
        part(facts, 0).alias("house_type"),
        F.col("_size").alias("house_size"),
        part(facts, 2).alias("direction"),
        part(facts, 3).alias("fitment"),
        part(facts, 4).alias("level"),
        part(facts, 5).alias("build_type"),
        reason.alias("reject_reason"),
    ]
    # Emitted through a generator: a later filter on reject_reason then stays
    # above it instead of being pushed down with every extraction copied into it.
    return typed.select(F.inline(F.array(F.struct(*out))))


LISTING_OUT = ["house_id", "title", "district", "community", "position", "tax",
               "total_price", "unit_price", "link", *FACT_COLUMNS]


def extract_listings(pages: DataFrame, district: Column | None = None,
                     site: Site = Site(), marker: str = CARD_MARKER,
                     card_end: str | None = None, tasks: int | None = None, parsed: bool = False) -> DataFrame:
    """pages(page_id, url, html[, district]) -> parsed cards with ``reject_reason``.

    ``tasks`` deals the pages over so many tasks when the input has too few splits.
    ``parsed`` finds the cards as an HTML parser does (``functions.markup``, an Arrow pass), for landed
    pages; without it tags are matched natively, which well-formed markup allows.

    Split the result with ``kept`` / ``rejected``.  When both halves are
    needed, write it once first (as the collect job does), so the pages are
    parsed a single time.
    """
    if district is None:
        district = F.col("district") if "district" in pages.columns else F.lit(None).cast("string")
    keep = [c for c in ("page_id", "url", "dt") if c in pages.columns] + ["district_in"]
    src = spread(pages.select(*[c for c in keep if c != "district_in"], "html",
                              district.alias("district_in")), tasks)
    if parsed:
        cards = markup.explode_cards(src, CARD_CLASS, keep=tuple(keep))
    else:
        cards = explode_cards(src, marker=marker, card_end=card_end, keep=keep)
    return (parse_cards(cards, F.col("district_in"), site).withColumn("seq", F.col("page_id") * SEQ_STRIDE + F.col("pos"))
            .drop("district_in"))


def kept(parsed: DataFrame) -> DataFrame:
    cols = LISTING_OUT + ["seq"] + (["dt"] if "dt" in parsed.columns else [])
    return parsed.filter(F.col("reject_reason").isNull()).select(*cols)


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull()).select(
        "page_id", F.col("pos").cast("int").alias("pos"), "card", "reject_reason")


def extract_counts(parsed: DataFrame) -> DataFrame:
    """Total cards and errors in one pass (the collect stage's counters)."""
    return parsed.agg(
        F.count(F.lit(1)).alias("total_num"),
        F.count(F.col("reject_reason")).alias("err_num"),
    )


# --- result counts and the page frontier -------------------------------------

def result_count(html) -> Column:
    """The listing count a district's first page announces (null when absent)."""
    return strict_int(required_match(html, RESULT_COUNT_RE, strip=True))


def strict_int(c) -> Column:
    """``int(s)``: optional sign, digits (with '_' between), blanks around; else null."""
    s = F.translate(py_strip(c), FULLWIDTH_DIGITS, "0123456789")
    return F.when(s.rlike(r"^[+-]?[0-9](?:_?[0-9])*$"),
                  F.regexp_replace(s, "_", "").try_cast("bigint"))


def page_count(n, cap: int | None = LISTING_CAP) -> Column:
    """``ceil(min(cap, n) / per_page)``; 0 for n <= 0 or null.  No cap: all pages."""
    capped = col_(n) if cap is None else F.least(col_(n), F.lit(cap))
    return F.when(capped > 0, F.ceil(capped / F.lit(float(LISTINGS_PER_PAGE)))).otherwise(
        F.lit(0)).cast("int")


def page_frontier(counts: DataFrame, n: str = "house_num", slug: str = "district_en",
                  url_template: str | None = None, site: Site = Site(), cap: int | None = LISTING_CAP) -> DataFrame:
    """One row per page to fetch: ``page`` 1..pages and its URL.

    The site shows ``cap`` listings of a district at most; ``beyond_cap`` says how many
    more it announces.  ``sequence(1, 0)`` would count down, so districts without
    listings get no rows through an explicit empty array.
    """
    pages = page_count(F.col(n), cap)
    seq = F.when(pages > 0, F.sequence(F.lit(1), pages)).otherwise(F.array().cast("array<int>"))
    tmpl = url_template or (site.base + "/%s/pg%d/")
    beyond = F.lit(0) if cap is None else F.greatest(F.col(n) - cap, F.lit(0))
    return (counts.withColumn("beyond_cap", beyond.cast("bigint")).withColumn("page", F.explode(seq))
            .withColumn("url", F.format_string(tmpl, F.col(slug), F.col("page"))))


def price_bands(listings: DataFrame, group: str, price: str, cap: int = LISTING_CAP, bits: int = 32) -> DataFrame:
    """``(group, lo, hi, n, beyond_cap)``: each district's listings in price bands that the site shows whole.

    A band of more than ``cap`` listings is halved, again and again, until each part lies under the cap;
    prices are whole numbers from 0 to 2^``bits`` - 1 (fractions are cut off, others count at the
    nearest end).  Halving only ever cuts at powers of two, so all bands that can arise are known: listings are counted
    by price first, prices are counted at each of their ``bits`` + 1 levels, and a band is
    taken where it is small enough and the one around it is not.  One price of more than
    ``cap`` listings can't be cut any further: ``beyond_cap`` says by how many.
    Listings without a price or a group are in no band.
    """
    p = F.least(F.greatest(F.floor(F.col(price)), F.lit(0)), F.lit((1 << bits) - 1)).cast("bigint")
    counts = (listings.filter(F.col(price).isNotNull() & F.col(group).isNotNull() & ~F.isnan(F.col(price).cast("double")))
              .groupBy(F.col(group).alias("g"), p.alias("p")).agg(F.count(F.lit(1)).alias("n")))
    level = counts.select("g", "p", "n", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("level"))
    band = level.groupBy("g", "level", F.expr(f"shiftright(p, {bits} - level)").alias("at")).agg(F.sum("n").alias("n"))
    large = band.filter(F.col("n") > cap).select("g", (F.col("level") + 1).alias("level"), F.col("at").alias("around"))
    small = band.filter((F.col("n") <= cap) | (F.col("level") == bits)).withColumn("around", F.shiftright("at", 1))
    cut = small.join(large, ["g", "level", "around"], "left_semi")
    lo = F.expr(f"shiftleft(at, {bits} - level)")
    return small.filter("level = 0").unionByName(cut).select(
        F.col("g").alias(group), lo.alias("lo"), (lo + F.expr(f"shiftleft(1L, {bits} - level)") - 1).alias("hi"), "n",
        F.greatest(F.col("n") - cap, F.lit(0)).alias("beyond_cap"))


def banded_frontier(bands: DataFrame, slug: str = "district_en", site: Site = Site(), cap: int = LISTING_CAP) -> DataFrame:
    """One row per page to fetch of each price band; its address names the band."""
    at = F.format_string("%s/p%d-%d", F.col(slug), F.col("lo"), F.col("hi"))
    return page_frontier(bands.withColumn("_slug", at), "n", "_slug", site=site, cap=cap).drop("_slug")


def frontier_status(frontier: DataFrame, landed: DataFrame, url: str = "url") -> DataFrame:
    """The frontier with ``landed``: whether a page of that address has landed.

    Addresses are compared without a closing slash; landed copies count once.
    """
    plain = lambda c: F.regexp_replace(c, "/+$", "")
    there = landed.select(plain(F.col(url)).alias("_at")).distinct().withColumn("_hit", F.lit(True))
    return (frontier.withColumn("_at", plain(F.col("url"))).join(there, "_at", "left")
            .withColumn("landed", F.coalesce("_hit", F.lit(False))).drop("_at", "_hit"))


def district_from_url(url) -> Column:
    return required_match(url, DISTRICT_IN_URL_RE)
