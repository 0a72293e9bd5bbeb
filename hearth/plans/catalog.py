"""The operator catalog run over the driver's tables.

Each entry applies the library's operators to whole driver tables (the
listing domain has no public sample data, so listing-shaped inputs such as
card HTML are built from table rows inside the query, identically in the SQL
oracle).  Every computed column is aliased so it matches ``oracle.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions import codec, imagemeta, images as img, markup, text as tx
from hearth.operators import cards, enrich, extract, gallery, metrics, preview, prompt, score, screen
from hearth.session import checkpoint_root, spread
from hearth.sources import buckets, commits, files, regions

QueryFn = Callable[[SparkSession, str], DataFrame]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Thresholds used on the driver tables (near the medians of lineitem).
UNIT_LIMIT = 2090.0
TOTAL_LIMIT = 53028.0
TYPE_MARK = "ECO"
PRICE_FLAG = 910.0
PRICE_FREQ = 950.0
SITE = extract.Site()


def _unit_price(li: DataFrame):
    return F.try_divide(li["l_extendedprice"], li["l_quantity"])


def flagged_lineitem(spark, sf) -> DataFrame:
    li = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    return li.select(
        "*",
        screen.flag_above(_unit_price(li), UNIT_LIMIT).alias("is_unit_price_high"),
        screen.flag_above(F.col("l_extendedprice"), TOTAL_LIMIT).alias("is_total_price_high"))


# --- flagship -----------------------------------------------------------------

def flagship(spark, sf):
    """Screen lineitem on unit and total price, skip orders already finished
    (anti-join), join part, and report the 10 most frequent part names."""
    kept = screen.keep_unflagged(flagged_lineitem(spark, sf),
                                 ("is_unit_price_high", "is_total_price_high"))
    done = (load(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
            .select(F.col("o_orderkey").alias("l_orderkey")))
    todo = enrich.pending(kept, done, "l_orderkey")
    part = load(spark, sf, "part").select("p_partkey", "p_name")
    joined = todo.join(part, todo["l_partkey"] == part["p_partkey"])
    return screen.value_counts(joined, "p_name", top=10)


# --- extraction ---------------------------------------------------------------

def card_explode(spark, sf):
    pages = load(spark, sf, "pages").select("page_id", "html")
    cards = extract.explode_cards(pages, marker="<li>", card_end="</li>", keep=("page_id",))
    return cards.select("page_id", F.col("pos").cast("int").alias("pos"),
                        tx.first_match("card", r'href="(.*?)"').alias("href"),
                        tx.first_match("card", r">(.*?)</a>").alias("text"))


def first_match_default(spark, sf):
    pages = load(spark, sf, "pages").select("page_id", "url", "html")
    return pages.select(
        "page_id",
        tx.first_match("html", r"<title>(.*?)</title>").alias("title"),
        tx.first_match("html", r"<h1>(.*?)</h1>").alias("h1"),
        tx.first_match("html", r"<p>(.*?)</p>").alias("para"),
        tx.first_match("url", r"\?([^#]*)").alias("query"),
        tx.first_match("url", r"#(.*)$").alias("fragment"))


def _url_parts(pages: DataFrame):
    return tx.split_parts(pages["url"], "/")


def facts_split(spark, sf):
    pages = load(spark, sf, "pages")
    parts = _url_parts(pages)
    tail = tx.part(parts, 4)
    return pages.select(
        "page_id",
        F.size(parts).cast("bigint").alias("n_parts"),
        tx.part(parts, 0).alias("scheme"),
        tx.part(parts, 2).alias("host"),
        tx.part(parts, 3).alias("lang"),
        tail.alias("tail"),
        tx.strict_double(F.regexp_replace(tail, "[?#].*$", "")).alias("tail_num"),
        tx.part(parts, 5).alias("extra"))


def extract_reject(spark, sf):
    pages = load(spark, sf, "pages")
    parts = _url_parts(pages)
    num = tx.strict_double(F.regexp_replace(tx.part(parts, 4), "[?#].*$", ""))
    reason = extract.first_reason([
        (extract.MISSING_ID, tx.required_match("html", r"<h1>(.*?)</h1>").isNull()),
        (extract.BAD_NUMBER, num.isNull()),
        (extract.SHORT_FACTS, F.size(parts) < 6),
    ])
    return (pages.select(F.coalesce(reason, F.lit("kept")).alias("outcome"))
            .groupBy("outcome").agg(F.count(F.lit(1)).alias("n")))


# Listing pages built from part rows: 30 cards per page, in the markup shape the
# extraction patterns expect, with missing ids, bad prices, short / long fact
# lists and missing facts spread over the table by the row's own values.
def _card_html(p: DataFrame):
    k = F.col("p_partkey").cast("string")
    link = F.concat(F.lit("https://h.example/ershoufang/"), k, F.lit(".html"))
    level = F.element_at(F.array(F.lit("高"), F.lit("中"), F.lit("低")),
                         (F.col("p_partkey") % 3 + 1).cast("int"))
    facts = F.concat(
        (F.col("p_size") % 4 + 1).cast("string"), F.lit("室1厅 | "),
        (F.col("p_size") + 40).cast("string"), F.lit(".5平米 | 南 北 | 精装 | "),
        level, F.lit("楼层(共"), (F.col("p_size") % 30 + 2).cast("string"), F.lit("层)"),
        F.when(F.col("p_size") % 13 == 0, F.lit("")).otherwise(F.lit(" | 板楼")),
        F.when(F.col("p_size") % 11 == 0, F.lit(" | 2005年建")).otherwise(F.lit("")))
    total = F.when(F.col("p_size") % 17 == 0, F.lit("暂无")).otherwise(
        F.concat((F.col("p_partkey") % 400 + 50).cast("string"), F.lit("."),
                 (F.col("p_size") % 10).cast("string")))
    unit = (F.col("p_partkey") * 7 % 9000 + 10000).cast("string")
    title = F.concat(F.lit(" "), F.col("p_name"),
                     F.when(F.col("p_size") % 3 == 0, F.lit(",南北，通透")).otherwise(F.lit("")),
                     F.lit(" "))
    id_attr = F.when(F.col("p_partkey") % 101 == 0, F.lit("")).otherwise(
        F.concat(F.lit(' data-housecode="'), k, F.lit('"')))
    facts_html = F.when(F.col("p_size") % 19 == 0, F.concat(F.lit("<span>"), facts, F.lit("</span>"))) \
        .otherwise(F.concat(F.lit('<span class="houseIcon"></span>'), facts))
    tax = F.when(F.col("p_size") % 2 == 0, F.lit('<span class="taxfree">满五年</span>')).otherwise(F.lit(""))
    return F.concat(
        F.lit('<li class="clear"><a class="img" href="'), link, F.lit('" target="_blank"><img src="x.jpg"></a>'),
        F.when(F.col("p_size") % 7 == 0, F.lit("<div class='info clear'>")).otherwise(F.lit('<div class="info clear">')),
        F.lit('<div class="title"><a class="" href="'), link, F.lit('"'),
        id_attr, F.lit(' target="_blank">'), title, F.lit("</a><!-- tag --></div>"),
        F.lit('<div class="flood"><div class="positionInfo"><span class="positionIcon"></span>'),
        F.lit('<a href="https://h.example/xiaoqu/'), k, F.lit('/" target="_blank">'), F.col("p_brand"),
        F.lit('</a>   -  <a href="https://h.example/ershoufang/a/" target="_blank">'), F.col("p_type"),
        F.lit("</a> </div></div>"),
        F.lit('<div class="address"><div class="houseInfo">'), facts_html, F.lit("</div></div>"),
        F.when(F.col("p_size") % 5 == 0, F.lit('<ul><li>近地铁</li><li>有电梯</li></ul>')).otherwise(F.lit("")),
        F.lit('<div class="tag">'), tax, F.lit("</div>"),
        F.lit('<div class="priceInfo"><div class="totalPrice totalPrice2"><i> </i><span class="">'), total,
        F.lit('</span><i>万</i></div><div class="unitPrice" data-price="'), unit,
        F.lit('"><span>'), unit, F.lit("元/平</span></div></div></div></li>"))


def listing_pages(spark, sf) -> DataFrame:
    p = load(spark, sf, "part")
    cards = p.select((F.col("p_partkey") / 30).cast("bigint").alias("page_id"), "p_partkey",
                     _card_html(p).alias("card"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "card"))),
                                    lambda x: x["card"]), "")
    return (cards.groupBy("page_id")
            .agg(body.alias("body"))
            .select("page_id",
                    F.concat(F.lit("district-"), (F.col("page_id") % 5).cast("string")).alias("district"),
                    F.concat(F.lit('<html><body><ul class="sellListContent">'), F.col("body"),
                             F.lit("</ul></body></html>")).alias("html")))


def listing_roundtrip(spark, sf):
    parsed = extract.extract_listings(listing_pages(spark, sf), site=SITE)
    return extract.kept(parsed)


def listing_rejects(spark, sf):
    parsed = extract.extract_listings(listing_pages(spark, sf), site=SITE)
    return extract.rejected(parsed).select("page_id", "pos", "reject_reason")


def title_clean(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    return docs.select("doc_id", tx.title_clean("text").alias("title"))


def _orders_per_region(spark, sf) -> DataFrame:
    """Orders per region: the listing counts; some lie above the cap and some below."""
    nation = load(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    region = load(spark, sf, "region").select("r_regionkey", "r_name")
    cust = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    orders = load(spark, sf, "orders").select("o_custkey")
    counts = (orders.join(cust, orders["o_custkey"] == cust["c_custkey"])
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("cnt")))
    return (region.join(counts, region["r_regionkey"] == counts["n_regionkey"], "left")
            .select("r_regionkey", F.lower(F.replace("r_name", F.lit(" "), F.lit("-"))).alias("district_en"),
                    F.coalesce("cnt", F.lit(0)).cast("bigint").alias("house_num")))


def page_frontier(spark, sf):
    counts = _orders_per_region(spark, sf)
    return extract.page_frontier(counts, site=SITE).select(
        "r_regionkey", "house_num", "beyond_cap", F.col("page").cast("int").alias("page"), "url")


def frontier_status(spark, sf):
    """Which pages of the frontier have landed: landed addresses are made of the pages' ids."""
    counts = _orders_per_region(spark, sf).select("r_regionkey", "district_en")
    pages = load(spark, sf, "pages").select((F.col("page_id") % 5).alias("r"), (F.col("page_id") % 101).alias("n"))
    landed = (pages.join(counts, F.col("r") == F.col("r_regionkey"))
              .select(F.format_string(SITE.base + "/%s/pg%d", "district_en", "n").alias("url")))
    out = extract.frontier_status(extract.page_frontier(_orders_per_region(spark, sf), site=SITE), landed)
    return out.select("r_regionkey", F.col("page").cast("int").alias("page"), "url", "landed")


def price_bands(spark, sf):
    """Pages of every region's orders by price band, so that none lies beyond the cap."""
    nation = load(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    cust = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    orders = load(spark, sf, "orders").select("o_custkey", "o_totalprice")
    placed = (orders.join(cust, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .select(F.col("n_regionkey").alias("r_regionkey"), "o_totalprice"))
    bands = extract.price_bands(placed, "r_regionkey", "o_totalprice")
    return extract.banded_frontier(bands.withColumn("district_en", F.col("r_regionkey").cast("string")), site=SITE).select(
        "r_regionkey", "lo", "hi", "n", "beyond_cap", F.col("page").cast("int").alias("page"), "url")


def frontier_first_page(spark, sf):
    return preview.first_page_only(page_frontier(spark, sf))


def result_count(spark, sf):
    nation = load(spark, sf, "nation")
    cust = load(spark, sf, "customer")
    counts = cust.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("cnt"))
    html = F.concat(F.lit('<div class="resultDes">共找到<span> '), F.col("cnt").cast("string"),
                    F.lit(" </span>套"), F.col("n_name"), F.lit("二手房</div>"))
    return (nation.join(counts, nation["n_nationkey"] == counts["c_nationkey"])
            .select("n_nationkey", extract.result_count(html).alias("house_num")))


def region_scope(spark, sf):
    region = load(spark, sf, "region")
    nation = load(spark, sf, "nation")
    members = nation.select("n_regionkey", "n_nationkey", "n_name")
    dim = regions.scoped_dimension(members, "n_regionkey", "n_nationkey")
    return (dim.join(region, dim["n_regionkey"] == region["r_regionkey"])
            .select("r_regionkey", "r_name", "scope", "n_nationkey", "n_name"))


def region_districts(spark, sf):
    """The districts of every city and scope, joined to nations by their place in the list."""
    nation = load(spark, sf, "nation").select("n_nationkey", "n_name")
    dims = None
    for city in regions.REGIONS:
        for scope in ("all", "small"):
            d = regions.districts(spark, city, scope)
            dims = d if dims is None else dims.unionByName(d)
    return (nation.join(dims, nation["n_nationkey"] % 4 == dims["ord"])
            .select("n_nationkey", "n_name", "city", "scope", "district_cn", "district_en"))


# --- screening ------------------------------------------------------------------

def _lineitem_part(spark, sf) -> DataFrame:
    li = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    part = load(spark, sf, "part").select("p_partkey", "p_type")
    joined = li.join(part, li["l_partkey"] == part["p_partkey"])
    return screen.add_flags(joined, level="p_type", total_price="l_extendedprice",
                            level_mark=TYPE_MARK, unit_limit=UNIT_LIMIT, total_limit=TOTAL_LIMIT,
                            unit_expr=_unit_price(li))


def screen_flags(spark, sf):
    return _lineitem_part(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        "is_high_level", "is_unit_price_high", "is_total_price_high")


def screen_keep(spark, sf):
    return screen.keep_unflagged(_lineitem_part(spark, sf)).select(
        "l_orderkey", "l_linenumber", "l_partkey")


def freq_top10(spark, sf):
    part = load(spark, sf, "part")
    flagged = part.select("p_brand", screen.flag_above("p_retailprice", PRICE_FLAG).alias("flag"))
    return screen.value_counts(flagged, "p_brand", where=F.col("flag") == 1, top=10)


def freq_top10_days(spark, sf):
    """The most frequent suppliers over all months, from one sketch per month."""
    li = load(spark, sf, "lineitem").select("l_suppkey", F.date_format("l_shipdate", "yyyyMM").alias("dt"))
    return screen.combined_top(screen.daily_sketches(li, "l_suppkey"), "l_suppkey")


def freq_price(spark, sf):
    part = load(spark, sf, "part")
    flagged = part.select("p_retailprice",
                          screen.flag_above("p_retailprice", PRICE_FREQ).alias("flag"))
    return screen.value_counts(flagged, "p_retailprice", where=F.col("flag") == 1)


def stage_counts(spark, sf):
    fl = flagged_lineitem(spark, sf)
    bad = (F.col("is_unit_price_high") == 1) | (F.col("is_total_price_high") == 1)
    return metrics.stage_metrics(fl, "screen", {"total": None, "kept": ~bad, "rejected": bad})


# --- joins and set operations ------------------------------------------------------

def merge_inner(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    li = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    return enrich.merge_inner(orders, li, "o_orderkey", take=("l_linenumber", "l_quantity"))


def resume_anti(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return enrich.pending(docs, load(spark, sf, "labels"), "doc_id")


def append_union(spark, sf):
    labels = load(spark, sf, "labels")
    new = enrich.pending(load(spark, sf, "documents").select("doc_id", "lang"), labels, "doc_id")
    return enrich.append_union(labels, new).select("doc_id", "quality", "toxic", "lang")


# --- galleries ------------------------------------------------------------------------

def _words(spark, sf) -> DataFrame:
    """Every document with all its words: galleries bounded by their own row.

    Building them costs some fifty times what moving a text does, so rows are dealt out first:
    the long texts of one file split do not wait for one core.
    """
    docs = load(spark, sf, "documents").select("doc_id", "text")
    return spread(docs, int(spark.conf.get("spark.sql.shuffle.partitions"))).select("doc_id", F.split("text", " ").alias("words"))


def _word_gallery(words, url):
    """All words of a text as gallery entries; long ones are floor plans."""
    return codec.dict_assign(F.transform(words, lambda w: F.struct(
        url(w).alias("url"), F.when(F.length(w) >= 6, F.lit(gallery.PLAN_DESC)).otherwise(F.lit("客厅")).alias("descr"))))


def gallery_encode(spark, sf):
    ent = _words(spark, sf).select("doc_id", F.transform("words", lambda w, i: F.struct(
        w.alias("url"), i.cast("string").alias("descr"))).alias("entries"))
    # the gallery is used three times: build it in its own projection
    gal = ent.select("doc_id", codec.dict_assign(F.col("entries")).alias("g"))
    return gal.select("doc_id", codec.encode_keys("g").alias("urls"),
                      codec.encode_pairs("g").alias("url_dict"),
                      F.size("g").cast("bigint").alias("n"))


def gallery_decode(spark, sf):
    """Words as ``word##place`` entries; every third is malformed (no place)."""
    t = _words(spark, sf).select("doc_id", F.array_join(F.transform("words", lambda w, i: F.when(i % 3 == 2, w).otherwise(
        F.concat(w, F.lit("##"), i.cast("string")))), ";").alias("text"))
    # decoded in its own projection: beside the generator it would be evaluated for each of its rows
    d = t.select("doc_id", codec.decode("text").alias("d"))
    # (explode would have a filter on the gallery's size inferred, which decodes a second time)
    g = d.select("doc_id", F.explode_outer("d.gallery").alias("g"), F.col("d.malformed").cast("bigint").alias("malformed"))
    return g.filter("g is not null").select("doc_id", F.col("g.pos").cast("int").alias("pos"),
                    F.col("g.url").alias("url"), F.col("g.descr").alias("descr"), "malformed")


def image_kind_split(spark, sf):
    g = _words(spark, sf).select("doc_id", _word_gallery(F.col("words"), lambda w: w).alias("g"))
    kinds = g.select("doc_id", "g", gallery.kind("g", True).alias("plans"), gallery.kind("g", False).alias("rooms"))
    return kinds.select(
        "doc_id",
        F.array_join(F.transform("plans", lambda x: x["url"]), ";").alias("plan_urls"),
        F.array_join(F.transform("rooms", lambda x: x["url"]), ";").alias("room_urls"),
        gallery.preview("g").alias("preview"))


def thumb_rewrite(spark, sf):
    pages = load(spark, sf, "pages")
    raw = F.concat(F.lit(" `"), F.col("url"), F.lit("` "))
    u = img.resize_thumb(img.resize_thumb(img.tidy_url(raw), ".example.", ".sample."),
                         "http://", "https://")
    return pages.select("page_id", u.alias("thumb_url"))


# Fixed values for the sniffing fixture: magic bytes put before a document's text.
MAGIC = ["FFD8FF", "89504E470D0A1A0A", "474946383961", "474946383761", "424D00", "424D80",
         "49492A00", ""]


def _magic(key, options=MAGIC):
    return F.element_at(F.array(*[F.lit(m) for m in options]), (key % len(options) + 1).cast("int"))


def data_uri(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    content = F.concat(F.unhex(_magic(F.col("doc_id"))), F.encode(F.col("text"), "UTF-8"))
    uri = img.data_uri(content)
    return docs.select("doc_id",
                       F.regexp_extract(uri, r"^data:image/([a-z]*);", 1).alias("kind"),
                       F.length(uri).cast("bigint").alias("uri_len"),
                       F.md5(uri).alias("uri_md5"))


def gallery_extract(spark, sf):
    part = load(spark, sf, "part")
    k = F.col("p_partkey").cast("string")
    base = F.concat(F.lit("https://img.example/"), k)
    items = F.concat(
        F.lit('<li data-desc="户型图" data-index="0"><img src=" `'), base, F.lit('/plan.120x80.jpg` " alt=""></li>'),
        F.lit("<li data-desc='客厅'><img data-src=\"lazy.gif\" SRC='"), base, F.lit("/a.120x80.jpg'></li>"),
        F.lit('<li data-desc="卧室"><span>no image</span></li>'),
        F.lit('<li data-desc="书房"><img class="lazy"><img src="'), base, F.lit('/c.120x80.jpg"></li>'),
        F.lit('<li data-desc="外"><ul><li data-desc="内"><img src="'), base, F.lit('/n.120x80.jpg"></li></ul><img src="'),
        base, F.lit('/o.120x80.jpg"></li>'),
        F.lit('<li><img src="'), base, F.lit('/b.120x80.jpg?v=1&amp;s=2"></li>'),
        F.when(F.col("p_size") % 3 == 0,
               F.concat(F.lit('<li data-desc="'), F.col("p_type"), F.lit('"><img src="'), base,
                        F.lit('/a.120x80.jpg"></li>'))).otherwise(F.lit("")))
    block = F.when(F.col("p_size") % 10 == 0, F.lit("")).otherwise(
        F.concat(F.when(F.col("p_size") % 7 == 0, F.lit("<ul class='thumbs smallpic'>")).otherwise(F.lit('<ul class="thumbs smallpic">')),
                 items, F.lit('</ul><ul class="smallpic"><li><img src="later.jpg"></li></ul>')))
    html = F.concat(F.lit('<html><body><div class="thumbnail">'), block, F.lit("</div></body></html>"))
    pages = part.select(F.col("p_partkey").alias("house_id"),
                        F.concat(F.lit("https://h.example/ershoufang/"), k, F.lit(".html")).alias("link"),
                        html.alias("html"))
    det = gallery.extract_details(pages)
    return det.select("house_id", F.posexplode("gallery").alias("i", "g")).select(
        "house_id", F.col("g.pos").cast("int").alias("pos"), F.col("g.url").alias("url"),
        F.col("g.descr").alias("descr"))


def _messy_pages(spark, sf) -> DataFrame:
    """Pages of 30 parts whose cards are nested, left open, commented out, printed by scripts or carry '>' in attributes."""
    name, kind = F.col("p_name"), F.col("p_size") % 6
    div = lambda inner, attrs=' class="info clear"': F.concat(F.lit(f"<div{attrs}>"), inner, F.lit("</div>"))
    card = (F.when(kind == 0, F.concat(F.lit("<li>"), div(F.concat(name, F.lit("<div>x</div>")), ' title="a > b" class="info clear"'), F.lit("</li>")))
            .when(kind == 1, F.concat(F.lit("<li>"), div(name, " class='info clear'")))
            .when(kind == 2, F.concat(F.lit("<!-- <li>"), div(name), F.lit("</li> -->")))
            .when(kind == 3, F.concat(F.lit("<script>var t = '"), div(name), F.lit("';</script><LI><DIV CLASS=\"clear info clear\"></DIV><DIV CLASS='info  clear'>"), name,
                                      F.lit("<br>y</DIV>")))
            .when(kind == 4, F.concat(F.lit("<li>"), div(F.concat(name, F.lit("<p>one<p>two<b>three")))))
            .otherwise(F.concat(F.lit("<li>"), div(F.concat(name, F.lit("</li></span><i>z")), ' data-x=a/b class="info&#32;clear"'))))
    cards = load(spark, sf, "part").select((F.col("p_partkey") / 30).cast("bigint").alias("page_id"), "p_partkey", card.alias("card"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "card"))), lambda x: x["card"]), "\n")
    return cards.groupBy("page_id").agg(F.concat(F.lit("<!DOCTYPE html><html><body><ul>"), body, F.lit("</ul></body></html>")).alias("html"))


def card_parse(spark, sf):
    return markup.explode_cards(_messy_pages(spark, sf), extract.CARD_CLASS).select("page_id", "pos", "card")


def gallery_parse(spark, sf):
    """Galleries of pages with omitted end tags, comments, scripts and '>' in attributes."""
    k = F.col("p_partkey").cast("string")
    html = F.concat(
        F.lit('<div><!-- <ul class="smallpic"><li><img src="no"></ul> --><ul class="big smallpic">'
              '<li data-desc="a > b"><img alt="x > y" src="'), k, F.lit('-1.120x80.jpg"><li data-desc=户型图><p>text<img src='), k,
        F.lit('-2.120x80.jpg><img src="second"><li data-desc="none"><b>no image</b>'
              "<li data-desc='later'><script>document.write('<img src=\"no\">')</script><!-- <img src=no> --><IMG SRC=' `"), k,
        F.lit("-1.120x80.jpg` '></ul><ul class=smallpic><li><img src=no></ul></div>"))
    pages = load(spark, sf, "part").select(F.col("p_partkey").alias("house_id"), F.when(F.col("p_size") % 10 == 0, F.lit("<ul><li>x</ul>")).otherwise(html).alias("html"))
    found = gallery.parse_galleries(pages, keep=("house_id",))
    return found.select("house_id", F.explode("gallery").alias("g")).select(
        "house_id", F.col("g.pos").cast("int").alias("pos"), F.col("g.url").alias("url"), F.col("g.descr").alias("descr"))


def _scratch(spark, name: str) -> str:
    """A new place for a stored table in the cluster's shared folder."""
    return f"{checkpoint_root(spark)}/tables/{name}-{uuid.uuid4().hex}"


def snapshot_append(spark, sf):
    """Orders as a committed table by year: two appended runs (one of them sent again), a year
    replaced, and files of a run that never got to publish them."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", files.snapshot_day("o_orderdate").alias("day"),
                                              F.date_format("o_orderdate", "yyyy").alias("dt"))
    log = commits.CommitLog(spark, _scratch(spark, "orders"), orders.schema)
    log.append(orders.filter(F.col("o_orderstatus") == "F"), "finished")
    late = enrich.pending(orders, log.read(), "o_orderkey")
    for _ in range(2):
        log.append(late, "late")
    log.replace(orders.filter((F.col("dt") == "1995") & (F.col("o_orderstatus") != "F")), "open-1995", "1995")
    log.stage(orders, "lost")
    return log.read().select("o_orderkey", "o_orderstatus", "day", "dt")


def merge_bucketed(spark, sf):
    """``merge_inner`` on tables stored in buckets of the key: nothing is shuffled for the join."""
    a, b = _scratch(spark, "orders"), _scratch(spark, "lineitem")
    buckets.append_bucketed(load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), a, "o_orderkey")
    buckets.append_bucketed(load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity"), b, "o_orderkey")
    return enrich.merge_inner(buckets.read_bucketed(spark, a), buckets.read_bucketed(spark, b), "o_orderkey", take=("l_linenumber", "l_quantity"))


def resume_bucketed(spark, sf):
    """``resume_anti`` against done rows stored in buckets: only the candidates travel."""
    done = _scratch(spark, "labels")
    buckets.append_bucketed(load(spark, sf, "labels"), done, "doc_id")
    docs = load(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return enrich.pending(docs, buckets.read_bucketed(spark, done), "doc_id")


def csv_exchange(spark, sf):
    """Documents written as CSV and read back: texts with line breaks, quotes and commas."""
    docs = load(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    path = files.write_csv_table(docs, _scratch(spark, "csv"))
    back = files.read_csv_table(spark, path, docs.schema)
    return back.select("doc_id", "lang", "source", "n_chars", F.md5(F.encode("text", "UTF-8")).alias("text_md5"))


def image_scan(spark, sf):
    """One landed image file per supplier (GIF magic, then its name), read back and encoded."""
    s = load(spark, sf, "supplier").select((F.col("s_suppkey") % 100).alias("k"), "s_suppkey", "s_name")
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))), lambda x: x["s_name"]), ",")
    body = s.groupBy("k").agg(F.concat(F.lit("GIF89a"), names).alias("body"))
    path = _scratch(spark, "images")
    body.coalesce(1).write.partitionBy("k").text(path)
    uri = img.data_uri(F.col("content"))
    return files.read_images(spark, path).select(
        F.regexp_extract("url", "/k=([0-9]+)/", 1).cast("bigint").alias("k"), F.octet_length("content").cast("bigint").alias("n_bytes"),
        F.regexp_extract(uri, r"^data:image/([a-z]*);", 1).alias("kind"), F.md5(uri).alias("uri_md5"))


def _u32(n: Column) -> Column:
    return F.unhex(F.lpad(F.hex(n.cast("bigint")), 8, "0"))


def _u16(n: Column, little: bool = False) -> Column:
    h = F.lpad(F.hex(n.cast("bigint")), 4, "0")
    return F.unhex(F.concat(F.substring(h, 3, 2), F.substring(h, 1, 2)) if little else h)


def _hex(text: str) -> Column:
    return F.unhex(F.lit(text))


def _chunk(name: str, body: Column, right: Column | None = None) -> Column:
    """A PNG chunk; its checksum is 0 where ``right`` does not hold."""
    named = F.concat(F.encode(F.lit(name), "UTF-8"), body)
    checksum = _u32(F.crc32(named))
    return F.concat(_u32(F.octet_length(body)), named, checksum if right is None else F.when(right, checksum).otherwise(_hex("00000000")))


def image_headers(spark, sf):
    """One image per part (PNG, GIF or JPEG by its key) around its name: what their bytes tell.

    Of every seven sizes one is cut off, and the PNGs of another have a wrong checksum.
    """
    body = F.encode(F.concat_ws(" ", "p_name", "p_brand", "p_type"), "UTF-8")
    wide, high, nth = F.col("p_partkey") % 4000 + 1, F.col("p_size"), F.col("p_partkey") % 3
    png = F.concat(_hex("89504E470D0A1A0A"), _chunk("IHDR", F.concat(_u32(wide), _u32(high), _hex("0802000000"))),
                   _chunk("IDAT", body, F.col("p_size") % 7 != 1), _chunk("IEND", _hex("")))
    block = F.concat(F.unhex(F.lpad(F.hex(F.octet_length(body).cast("bigint")), 2, "0")), body, _hex("00"))
    gif = F.concat(F.encode(F.lit("GIF89a"), "UTF-8"), _u16(wide, True), _u16(high, True), _hex("800000" + "000000FFFFFF" + "21FE"), block,
                   _hex("2C00000000"), _u16(wide, True), _u16(high, True), _hex("0002"), block, _hex("3B"))
    jpeg = F.concat(_hex("FFD8FFE1"), _u16(F.octet_length(body) + 4), _hex("FFD9"), body, _hex("FFFFC0000B08"), _u16(high), _u16(wide), _hex("01011100"),
                    _hex("FFDA00080101003F0000"), body, _hex("FF00FFD3"), body, _hex("FFD9"))
    content = F.when(nth == 0, png).when(nth == 1, gif).otherwise(jpeg)
    images = load(spark, sf, "part").select("p_partkey", "p_size", content.alias("content"))
    kept = F.octet_length("content") - F.when(F.col("p_size") % 7 == 0, F.col("p_size") % 12 + 1).otherwise(0)
    images = images.withColumn("content", F.substring("content", F.lit(1), kept))
    return imagemeta.with_meta(images).select("p_partkey", F.octet_length("content").cast("bigint").alias("n_bytes"), "meta.*")


def cards_upkeep(spark, sf):
    """Customers' cards from orders stored by year: three runs, of which one is sent again and one
    replaces a year; the states of each year are written from that year's rows alone."""
    year = F.date_format("o_orderdate", "yyyy")
    entry = F.struct(F.lit(0).alias("pos"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".jpg")).alias("url"), F.lit("").alias("descr"))
    rows = load(spark, sf, "orders").select(
        F.col("o_custkey").alias("house_id"), F.col("o_orderkey").alias("seq"), year.alias("dt"), F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("district"), F.col("o_totalprice").alias("total_price"),
        F.filter(F.array(entry), lambda _: F.col("o_orderkey") % 3 == 0).alias("gallery"))
    log = commits.CommitLog(spark, _scratch(spark, "cards"), cards.state_schema(rows.schema))
    log.append(cards.day_states(rows.filter(F.col("dt") < "1996")), "early")
    for _ in range(2):
        log.append(cards.day_states(rows.filter(F.col("dt") >= "1996")), "late")
    log.replace(cards.day_states(rows.filter((F.col("dt") == "1994") & (F.col("district") != "F"))), "open-1994", "1994")
    got = cards.cards(log.read())
    return got.select("house_id", "info", F.array_join(F.transform("gallery", lambda x: x["url"]), ";").alias("urls"))


def image_join(spark, sf):
    """Documents' words as galleries, benchmark words as landed images: many texts share an image,
    many images land more than once, and some have no bytes."""
    details = _words(spark, sf).select(F.col("doc_id").alias("house_id"),
                                       _word_gallery(F.col("words"), lambda w: F.concat(F.lit("img/"), w)).alias("gallery"))
    word = load(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("w"))
    images = word.select(
        F.concat(F.lit("img/"), F.col("w")).alias("url"),
        F.when(F.length("w") % 5 != 0, F.concat(F.unhex(_magic(F.length("w"), ["FFD8FF", "89504E470D0A1A0A", ""])),
                                                F.encode("w", "UTF-8"))).alias("content"))
    att = gallery.attach_images(details, images)
    return att.select(F.col("house_id").alias("doc_id"), F.array_join("plan_uris", " ").alias("plans"),
                      F.array_join("room_uris", " ").alias("rooms"))


# --- rendering, prompts, scoring -------------------------------------------------------

def part_listings(spark, sf) -> DataFrame:
    """part rows in listing shape (no position, fitment, level or build type columns)."""
    p = load(spark, sf, "part")
    return p.select(
        F.col("p_partkey").alias("house_id"), F.col("p_name").alias("title"),
        F.col("p_brand").alias("district"), F.col("p_brand").alias("community"),
        F.col("p_retailprice").alias("total_price"),
        (F.col("p_retailprice") * 10).alias("unit_price"),
        F.col("p_type").alias("house_type"), F.col("p_size").cast("double").alias("house_size"),
        F.lit(None).cast("string").alias("direction"),
        F.col("p_partkey").alias("seq"))


def render_text(spark, sf):
    lst = part_listings(spark, sf)
    return lst.select(F.col("house_id").alias("p_partkey"), prompt.base_info(lst).alias("info"))


def number_text(spark, sf):
    """Prices of 16 and 17 digits, large ones and shares, each as a listing's text prints it."""
    price, qty = F.col("l_extendedprice").cast("double"), F.col("l_quantity").cast("double")
    made = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (price / qty).alias("unit"), (price * 1e15 / qty).alias("big"),
                                              (qty / (price * 1000)).alias("share"))
    return made.select("l_orderkey", "l_linenumber", *[tx.py_float_str(c).alias(c) for c in ("unit", "big", "share")])


def lookup(spark, sf):
    asked = (load(spark, sf, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 50))
             .select(F.col("l_partkey").alias("house_id")))
    views = prompt.listing_views(asked, _part_final(spark, sf))
    return views.select(F.col("house_id").alias("p_partkey"), "info",
                        F.array_join("plan_urls", ";").alias("plan_urls"),
                        F.array_join("room_urls", ";").alias("room_urls"))


def lookup_one(spark, sf):
    """One listing by its id: the filter reaches the scan."""
    views = prompt.listing_view(_part_final(spark, sf), 7)
    return views.select(F.col("house_id").alias("p_partkey"), "info",
                        F.array_join("plan_urls", ";").alias("plan_urls"),
                        F.array_join("room_urls", ";").alias("room_urls"))


def first_row_per_key(spark, sf):
    conv = load(spark, sf, "conversations")
    return prompt.first_per_key(conv, "conv_id", "turn").select("conv_id", "turn", "role", "text")


def first_nonempty_per_key(spark, sf):
    conv = load(spark, sf, "conversations")
    cond = (F.col("role") == "assistant") & (F.length("text") > 0)
    return prompt.first_per_key(conv, "conv_id", "turn", where=cond).select(
        "conv_id", "turn", "role", "text")


def _wishes(spark, sf) -> DataFrame:
    conv = load(spark, sf, "conversations")
    first_user = prompt.first_per_key(conv, "conv_id", "turn", where=F.col("role") == "user")
    return first_user.select(F.col("conv_id").alias("wish_id"), F.col("text").alias("user_input"))


def _part_final(spark, sf) -> DataFrame:
    lst = part_listings(spark, sf)
    pic = lambda name: F.concat(F.lit("img/"), F.col(name), F.lit("/450x300.jpg"))

    def entry(i, url, descr):
        return F.struct(F.lit(i).alias("pos"), url.alias("url"), F.lit(descr).alias("descr"))
    g = F.when(F.col("house_size") % 3 == 0, F.array(entry(0, pic("community"), "户型图"), entry(1, pic("house_type"), "客厅"),
                                                     entry(2, F.lit("img/none"), "卧室"))) \
        .otherwise(F.array().cast("array<struct<pos:int,url:string,descr:string>>"))
    return lst.withColumn("gallery", g)


def _part_images(spark, sf) -> DataFrame:
    """Landed images: one per brand and type, once for every part that has it."""
    part = load(spark, sf, "part").select(F.explode(F.array("p_brand", "p_type")).alias("w"))
    return part.select(F.concat(F.lit("img/"), F.col("w"), F.lit("/450x300.jpg")).alias("url"),
                       F.concat(F.unhex(F.lit("FFD8FF")), F.encode("w", "UTF-8")).alias("content"))


def _requests(spark, sf) -> DataFrame:
    p = load(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("house_id"), (F.col("p_partkey") % 100).alias("wish_id"))


def prompt_images(spark, sf):
    prompts = prompt.build_prompts(_requests(spark, sf), _wishes(spark, sf), _part_final(spark, sf), _part_images(spark, sf))
    return prompts.select("house_id", "wish_id", prompt.messages_json("messages").alias("messages_json"))


def score_all(spark, sf):
    """Every listing scored for one wish."""
    final = _part_final(spark, sf)
    requests = prompt.requests_for_wish(final, 3)
    prompts = prompt.build_prompts(requests, _wishes(spark, sf), final)
    return score.reply_batch(prompts, score.offline_stub).select("house_id", "wish_id", "reply", "score")


def reply_counts(spark, sf):
    out = score.reply_batch(prompt.build_prompts(_requests(spark, sf), _wishes(spark, sf), _part_final(spark, sf)), score.offline_stub)
    return metrics.stage_metrics(out, "replies", {
        "asked": None, "answered": F.col("outcome") == "answered", "failed": F.col("outcome") != "answered"})


def prompt_json(spark, sf):
    prompts = prompt.build_prompts(_requests(spark, sf), _wishes(spark, sf), _part_final(spark, sf))
    return prompts.select("house_id", "wish_id", prompt.messages_json("messages").alias("messages_json"))


def score_batch(spark, sf):
    prompts = prompt.build_prompts(_requests(spark, sf), _wishes(spark, sf), _part_final(spark, sf))
    return score.reply_batch(prompts, score.offline_stub).select("house_id", "wish_id", "reply", "score")


def shortlist(spark, sf):
    replies = score_batch(spark, sf)
    return score.shortlist(replies, part_listings(spark, sf))


def shortlisted_listings(spark, sf):
    return (score.shortlisted_listings(score_batch(spark, sf), part_listings(spark, sf))
            .select("wish_id", "house_id", "score", "title", "community", "total_price"))


def kv_parse(spark, sf):
    s = load(spark, sf, "supplier")
    k = F.col("s_suppkey").cast("string")
    text = F.concat(F.col("s_name"), F.lit("##m"), k, F.lit("; alt ## "),
                    F.col("s_nationkey").cast("string"), F.lit(" ;bad;a##b##c;"), F.col("s_name"),
                    F.lit(" ## dup"), (F.col("s_suppkey") % 3).cast("string"))
    parsed = s.select("s_suppkey", codec.decode_model_list(text).alias("models"), codec.first_model(text).alias("first_model"))
    return parsed.select("s_suppkey", F.explode("models").alias("m"), "first_model").select(
        "s_suppkey", F.col("m.pos").cast("int").alias("pos"), F.col("m.name").alias("name"),
        F.col("m.model").alias("model"), "first_model")


def preview_limits(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return preview.first_n(orders, 20, "o_orderkey")


QUERIES: dict[str, QueryFn] = {
    "flagship": flagship,
    "card_explode": card_explode,
    "first_match_default": first_match_default,
    "facts_split": facts_split,
    "extract_reject": extract_reject,
    "listing_roundtrip": listing_roundtrip,
    "listing_rejects": listing_rejects,
    "title_clean": title_clean,
    "page_frontier": page_frontier,
    "frontier_first_page": frontier_first_page,
    "price_bands": price_bands,
    "result_count": result_count,
    "region_scope": region_scope,
    "region_districts": region_districts,
    "frontier_status": frontier_status,
    "screen_flags": screen_flags,
    "screen_keep": screen_keep,
    "freq_top10": freq_top10,
    "freq_top10_days": freq_top10_days,
    "freq_price": freq_price,
    "stage_counts": stage_counts,
    "merge_inner": merge_inner,
    "resume_anti": resume_anti,
    "append_union": append_union,
    "gallery_encode": gallery_encode,
    "gallery_decode": gallery_decode,
    "image_kind_split": image_kind_split,
    "thumb_rewrite": thumb_rewrite,
    "data_uri": data_uri,
    "gallery_extract": gallery_extract,
    "card_parse": card_parse,
    "gallery_parse": gallery_parse,
    "snapshot_append": snapshot_append,
    "merge_bucketed": merge_bucketed,
    "resume_bucketed": resume_bucketed,
    "csv_exchange": csv_exchange,
    "image_scan": image_scan,
    "image_headers": image_headers,
    "cards_upkeep": cards_upkeep,
    "image_join": image_join,
    "render_text": render_text,
    "number_text": number_text,
    "lookup": lookup,
    "lookup_one": lookup_one,
    "first_row_per_key": first_row_per_key,
    "first_nonempty_per_key": first_nonempty_per_key,
    "prompt_json": prompt_json,
    "score_batch": score_batch,
    "shortlist": shortlist,
    "shortlisted_listings": shortlisted_listings,
    "prompt_images": prompt_images,
    "score_all": score_all,
    "reply_counts": reply_counts,
    "kv_parse": kv_parse,
    "preview_limits": preview_limits,
}
