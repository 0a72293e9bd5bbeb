"""Galleries: detail page -> ordered (url, descr) array; kinds; image attachment.

Extraction is per row (a page's gallery never leaves its row), so it is one
narrow stage.  Attaching image bytes is the only shuffle: gallery entries are
exploded, joined to the image table on url, and re-collected per listing.  The
8-per-kind slice happens before that join, so each listing contributes at most
16 rows and every re-collected group is bounded.

SURVEY IDs: P10-P15, F6-F8, L4, L6, J3, A6, M2 (with functions/images.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions.codec import decode_pairs, dict_assign, encode_keys, encode_pairs
from hearth.functions import imagemeta, markup
from hearth.functions.html import element_text, elements
from hearth.functions.images import data_uri, resize_thumb, tidy_url
from hearth.functions.text import col_, java_pattern, let
from hearth.operators import metrics
from hearth.session import spread

# Gallery markup and the description that marks a floor plan.
_CLASS = r"""class\s*=\s*(?:"(?:[^"]*\s)?smallpic(?:\s[^"]*)?"|'(?:[^']*\s)?smallpic(?:\s[^']*)?'|smallpic(?=[\s>]))"""
GALLERY_OPEN_RE = rf"(?is)<ul\b[^>]*\s{_CLASS}[^>]*>"
IMG_TAG_RE = r"""(?is)<img\b(?:[^>"']|"[^"]*"|'[^']*')*>"""


def attr_re(name: str) -> str:
    """Attribute ``name`` in a tag (name after a blank, any case), its value
    double-quoted, single-quoted or bare: three groups, one of them set."""
    dq, sq, bare = '"([^"]*)"', "'([^']*)'", "([^\\s\"'=<>`]+)"
    return "\\s(?i:" + name + ")\\s*=\\s*(?:" + dq + "|" + sq + "|" + bare + ")"


SRC_RE = attr_re("src")
DESC_RE = attr_re("data-desc")
PLAN_DESC = "户型图"
# Character references decoded in attribute values (&amp; last).
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"),
                 ("&amp;", "&")]


def attr_value(tag, pattern: str) -> Column:
    """The attribute's value, unescaped (null when the tag lacks it)."""
    p = java_pattern(pattern)
    t = col_(tag)
    return F.when(t.rlike(p), unescape_attr(F.concat(*[F.regexp_extract(t, p, g) for g in (1, 2, 3)])))


def unescape_attr(c) -> Column:
    """Attribute text as an HTML parser returns it, for the common references."""
    out = col_(c)
    for ref, ch in HTML_ENTITIES:
        out = F.replace(out, F.lit(ref), F.lit(ch))
    return out
MAX_PER_KIND = 8


def gallery_block(html) -> Column:
    """Inner HTML of the first gallery list; null when the page has none.

    The list ends where its own ``ul`` closes, so lists may nest in it.
    """
    after = F.get(F.split(col_(html), java_pattern(GALLERY_OPEN_RE), 2), 1)
    return F.when(after.isNotNull(), element_text(after, "ul"))


def gallery_from_html(html, origin: str = "120x80", dest: str = "450x300") -> Column:
    """Gallery array from a detail page (null when there is no gallery list).

    Each ``li``, nested ones too, gives (url, descr): its ``data-desc`` attribute
    ('' when absent) and the ``src`` of the first ``img`` anywhere in it, tidied
    and resized; a ``li`` whose first ``img`` is missing or has no ``src`` is skipped; a
    repeated url keeps its first position and last descr.  Attribute values are unescaped.
    """
    img_re = java_pattern(IMG_TAG_RE)

    def from_block(block):
        found = F.transform(elements(block, "li"), lambda x: F.struct(
            F.coalesce(attr_value(x["open"], DESC_RE), F.lit("")).alias("descr"),
            attr_value(F.regexp_extract(x["inside"], img_re, 0), SRC_RE).alias("src")))
        return F.when(block.isNotNull(), gallery_from_items(found, origin, dest))

    return let(gallery_block(html), from_block)


def gallery_from_items(items, origin: str = "120x80", dest: str = "450x300") -> Column:
    """``(descr, src)`` items -> gallery array; null for null items.  Items without ``src`` are skipped, a
    repeated url keeps its first position and last descr."""
    with_src = F.filter(col_(items), lambda x: x["src"].isNotNull())
    return dict_assign(F.transform(with_src, lambda x: F.struct(
        resize_thumb(tidy_url(x["src"]), origin, dest).alias("url"), x["descr"].alias("descr"))))


def parse_galleries(detail_pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("house_id", "link")) -> DataFrame:
    """``keep`` columns and ``gallery`` (null without a gallery list), the markup read as a parser reads it
    (``functions.markup``): for landed pages, which need not be well-formed."""
    return markup.read_galleries(detail_pages, html, keep).select(*keep, gallery_from_items("items").alias("gallery"))


def extract_details(detail_pages: DataFrame, key: str = "house_id", link: str = "link",
                    html: str = "html", tasks: int | None = None) -> DataFrame:
    """detail pages (house_id, link, html) -> details (house_id, link, gallery).

    Pages without a gallery list give no row (they are retried on the next run).
    ``tasks`` deals the pages over so many tasks when the input has too few splits.
    """
    g = gallery_from_html(F.col(html))
    detail_pages = spread(detail_pages.select(key, link, html), tasks)
    # explode([g] without nulls) drops pages without a gallery in the same
    # operator that computes it (a filter on g would be pushed below and
    # evaluate the extraction twice)
    return detail_pages.select(F.col(key).alias("house_id"), F.col(link).alias("link"),
                               F.explode(F.array_compact(F.array(g))).alias("gallery"))


def detail_counts(detail_pages: DataFrame, html: str = "html") -> DataFrame:
    """found / missing / failed in one pass (failed = no page text at all)."""
    has_block = gallery_block(F.col(html)).isNotNull()
    return detail_pages.agg(
        F.count(F.when(has_block, 1)).alias("found"),
        F.count(F.when(F.col(html).isNotNull() & ~has_block, 1)).alias("missing"),
        F.count(F.when(F.col(html).isNull(), 1)).alias("failed"),
    )


def to_text(details: DataFrame) -> DataFrame:
    """details -> interchange text form (urls, url_dict)."""
    return details.select("house_id", "link",
                          encode_keys("gallery").alias("urls"),
                          encode_pairs("gallery").alias("url_dict"))


def from_text(details_text: DataFrame, column: str = "url_dict") -> DataFrame:
    """Interchange text -> gallery array; '' or null gives an empty gallery."""
    return details_text.withColumn("gallery", decode_pairs(F.col(column))).drop("urls", column)


def kind(gallery, plans: bool, max_num: int = MAX_PER_KIND, plan_desc: str = PLAN_DESC) -> Column:
    """Floor plans (descr == plan_desc) or the other pictures, first ``max_num``."""
    g = col_(gallery)
    sel = F.filter(g, (lambda x: x["descr"] == plan_desc) if plans
                   else (lambda x: ~F.coalesce(x["descr"] == plan_desc, F.lit(False))))
    return F.slice(sel, 1, max_num)


def preview(gallery) -> Column:
    """First url of each kind as text (a quick look at a gallery)."""
    first = lambda arr: F.coalesce(F.get(arr, 0)["url"], F.lit(""))
    return F.concat(F.lit("户型图: "), first(kind(gallery, True)),
                    F.lit("; 房屋图片: "), first(kind(gallery, False)))


def attach_images(details: DataFrame, images: DataFrame, key: str = "house_id",
                  max_num: int = MAX_PER_KIND, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per listing, plan and room images as data URIs, in gallery order.

    ``images(url, content)``: entries with an empty url or no image bytes are
    dropped, and a url landed several times counts once (its least bytes).
    Output: key, plan_uris ARRAY<STRING>, room_uris ARRAY<STRING>.  Only keys with at
    least one image get a row.  With ``carry`` every key gets one (``details`` then has
    one row per key) and brings those columns along, so that ``details`` is worked out
    only once.  Each key contributes at most 2 x ``max_num`` rows, so the re-collect
    per key is bounded.

    Every url is joined as it is, so an image travels once.  The partitions of urls that very many
    listings share (a placeholder) are measured as they are shuffled, and adaptive
    execution splits those alone and hands out their image to each part.
    Bytes travel as they are and are encoded once, after the collect.
    """
    per_kind = details.select(
        key, *carry,
        F.concat(
            F.transform(kind("gallery", True, max_num),
                        lambda x: F.struct(F.lit(0).alias("kind"), x["pos"].alias("pos"),
                                           x["url"].alias("url"))),
            F.transform(kind("gallery", False, max_num),
                        lambda x: F.struct(F.lit(1).alias("kind"), x["pos"].alias("pos"),
                                           x["url"].alias("url"))),
        ).alias("wanted"))
    # (explode would have a filter on the array's size inferred, which works the array out a second time)
    wanted = per_kind.select(key, *carry, F.explode_outer("wanted").alias("w")).select(key, *carry, "w.kind", "w.pos", "w.url")
    # made unique by more than the join's key, so that the join has a shuffle of its own on this side: only
    # partitions that come straight from a shuffle are split
    landed = (images.filter(F.col("content").isNotNull() & (F.col("url") != "")).groupBy("url", F.length("url"))
              .agg(F.min("content").alias("content")).select("url", "content"))
    got = wanted.join(landed, "url", "left") if carry else wanted.filter(F.col("url") != "").join(landed, "url")
    seen = F.when(F.col("content").isNotNull(), F.struct("kind", "pos", "content"))
    both = got.groupBy(key).agg(F.array_sort(F.collect_list(seen)).alias("imgs"), *[F.first(c).alias(c) for c in carry])

    def uris(k: int) -> Column:
        return F.transform(F.filter("imgs", lambda x: x["kind"] == k), lambda x: data_uri(x["content"]))
    return both.select(key, *carry, uris(0).alias("plan_uris"), uris(1).alias("room_uris"))


#: States of image files that a prompt can do without: they hold no picture, or not all of it.
BROKEN = ("empty", "cut", "damaged")


def sound_images(images: DataFrame) -> DataFrame:
    """Landed images without the broken ones (``functions.imagemeta``); formats it does not know stay."""
    return imagemeta.with_meta(images, name="_meta").filter(~F.col("_meta.state").isin(*BROKEN)).drop("_meta")


def image_counts(images: DataFrame) -> DataFrame:
    """``landed`` and one counter for each state an image can be in, as ``metrics(stage, name, value)``."""
    state = F.col("_meta.state")
    return metrics.stage_metrics(imagemeta.with_meta(images, name="_meta"), "images", {
        "landed": None, **{s: state == s for s in ("whole", *BROKEN, "unknown")}})


def no_images(c) -> Column:
    """An absent image list as an empty one."""
    return F.coalesce(col_(c), F.array().cast("array<string>"))
