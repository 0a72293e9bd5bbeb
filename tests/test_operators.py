"""Golden cases of the listing operators on inline fixtures."""

import pytest
from pyspark.sql import functions as F

from hearth.operators import enrich, extract, gallery, metrics, prompt, score, screen
from tests import fixtures as fx


def pages_df(spark, *html, district="丛台区"):
    rows = [(i, f"https://x/ershoufang/congtaiqu/pg{i + 1}/", h, district) for i, h in enumerate(html)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, district string")


def test_extract_good_card(spark):
    parsed = extract.extract_listings(pages_df(spark, fx.page(fx.card())))
    r = extract.kept(parsed).first()
    assert r.house_id == 101 and r.title == "南北-通透-两居" and r.district == "丛台区"
    assert r.community == "远洋山水" and r.tax == "满五年"
    assert (r.total_price, r.unit_price, r.house_size) == (560.0, 62570.0, 89.5)
    assert (r.house_type, r.direction, r.fitment, r.level, r.build_type) == (
        "2室1厅", "南 北", "精装", "高楼层(共18层)", "板楼")
    assert r.link == "https://hd.example.com/ershoufang/101.html" and r.seq == 0


def test_extract_rejects_in_order(spark):
    cards = [
        fx.card(house_id="1"),
        fx.card(house_id="2", facts="2室1厅 | 89.5平米 | 南 | 精装 | 低楼层"),            # 5 facts
        fx.card(house_id="3", facts="2室1厅 | 70平米 | 南 | 简装 | 中楼层 | 塔楼 | 2000年建"),  # 7 facts
        fx.card(house_id="4", total="-"),
        fx.card(house_id="5", total="暂无"),
        fx.card(house_id="6", with_id=False),
        fx.card(house_id="7", with_facts=False),
        fx.card(house_id="8", facts="车位"),
        fx.card(house_id="9", unit="n/a"),
    ]
    parsed = extract.extract_listings(pages_df(spark, fx.page(*cards)))
    got = {r.pos: r.reject_reason for r in parsed.select("pos", "reject_reason").collect()}
    assert got == {0: None, 1: "short_facts", 2: None, 3: "bad_number", 4: "bad_number",
                   5: "missing_id", 6: "missing_facts", 7: "short_facts", 8: "bad_number"}
    kept = extract.kept(parsed).orderBy("seq").collect()
    assert [r.house_id for r in kept] == [1, 3] and kept[1].build_type == "塔楼"
    counts = extract.extract_counts(parsed).first()
    assert (counts.total_num, counts.err_num) == (9, 7)
    # screened + rejected = total
    assert extract.kept(parsed).count() + extract.rejected(parsed).count() == 9


def test_page_without_cards(spark):
    parsed = extract.extract_listings(pages_df(spark, "<html>nothing</html>"))
    assert parsed.count() == 0


@pytest.mark.parametrize("n,pages", [(0, 0), (1, 1), (30, 1), (31, 2), (5000, 100)])
def test_page_frontier(spark, n, pages):
    df = spark.createDataFrame([("congtaiqu", n)], "district_en string, house_num bigint")
    out = extract.page_frontier(df).orderBy("page").collect()
    assert len(out) == pages
    if pages:
        assert out[0].url == "https://hd.example.com/ershoufang/congtaiqu/pg1/"


def test_result_count(spark):
    df = spark.createDataFrame([(fx.count_page(1234),), ("no count",), (fx.count_page("１_２３４"),)],
                               "h string")
    got = [r.n for r in df.select(extract.result_count(F.col("h")).alias("n")).collect()]
    assert got == [1234, None, int("１_２３４")]


def test_screen_flags(spark):
    rows = [("高楼层", 12000.0, 130.0), ("低楼层", 12000.01, 130.5), (None, float("nan"), None)]
    df = spark.createDataFrame(rows, "level string, unit_price double, total_price double")
    got = [tuple(r) for r in screen.add_flags(df).select(
        "is_high_level", "is_unit_price_high", "is_total_price_high").collect()]
    assert got == [(1, 0, 0), (0, 1, 1), (0, 0, 0)]
    assert screen.screen(df).count() == 1


def test_screen_flags_on_text(spark):
    df = spark.createDataFrame([("中", "12000.0", "abc"), ("中", "12000.01", "130.5")],
                               "level string, unit_price string, total_price string")
    got = [tuple(r) for r in screen.add_flags(df).select(
        "is_unit_price_high", "is_total_price_high").collect()]
    assert got == [(0, 0), (1, 1)]


def test_value_counts_ties_by_key(spark):
    df = spark.createDataFrame([(v,) for v in "bbaacd"] + [(None,)], "k string")
    assert [(r.k, r.n) for r in screen.value_counts(df, "k", top=3).collect()] == [
        ("a", 2), ("b", 2), ("c", 1)]


def test_gallery_extract(spark):
    plans = [("户型图", f"http://i/p{i}.120x80.jpg") for i in range(10)]
    rooms = [("客厅", " `http://i/r0.120x80.jpg` "), ("卧室", None), (None, "http://i/r1.jpg"),
             ("厨房", "http://i/r0.120x80.jpg")]
    rows = [(1, "l1", fx.detail_page(plans + rooms)), (2, "l2", fx.detail_page([], with_gallery=False))]
    df = spark.createDataFrame(rows, "house_id bigint, link string, html string")
    det = gallery.extract_details(df).collect()
    assert [r.house_id for r in det] == [1]
    g = det[0].gallery
    assert len(g) == 12
    assert (g[10].url, g[10].descr, g[10].pos) == ("http://i/r0.450x300.jpg", "厨房", 10)
    assert (g[11].url, g[11].descr) == ("http://i/r1.jpg", "")
    k = spark.createDataFrame(det).select(F.size(gallery.kind("gallery", True)).alias("p"),
                                          F.size(gallery.kind("gallery", False)).alias("r"),
                                          gallery.preview("gallery").alias("v")).first()
    assert (k.p, k.r) == (8, 2)
    assert k.v == "户型图: http://i/p0.450x300.jpg; 房屋图片: http://i/r0.450x300.jpg"
    c = gallery.detail_counts(df.unionByName(spark.createDataFrame(
        [(3, "l3", None)], "house_id bigint, link string, html string"))).first()
    assert (c.found, c.missing, c.failed) == (1, 1, 1)


def test_gallery_text_roundtrip(spark):
    det = spark.createDataFrame(
        [(1, "l", [(0, "u", "a"), (1, "v", "b")])],
        "house_id bigint, link string, gallery array<struct<pos:int,url:string,descr:string>>")
    t = gallery.to_text(det).first()
    assert (t.urls, t.url_dict) == ("u;v", "u##a;v##b")
    back = gallery.from_text(gallery.to_text(det)).first().gallery
    assert [(e.pos, e.url, e.descr) for e in back] == [(0, "u", "a"), (1, "v", "b")]


def test_attach_images(spark):
    det = spark.createDataFrame(
        [(1, [(0, "a", "户型图"), (1, "b", "客厅"), (2, "c", "户型图"), (3, "", "x")])],
        "house_id bigint, gallery array<struct<pos:int,url:string,descr:string>>")
    imgs = spark.createDataFrame([("a", bytes.fromhex("FFD8FF01")), ("c", bytes.fromhex("89504E470D0A1A0A")),
                                  ("b", None)], "url string, content binary")
    r = gallery.attach_images(det, imgs).first()
    assert [u[:22] for u in r.plan_uris] == ["data:image/jpeg;base64", "data:image/png;base64,"]
    assert r.room_uris == []


def test_merge_and_resume(spark):
    lst = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "house_id bigint, t string")
    det = spark.createDataFrame([(1, "g1"), (1, "g2"), (3, "g3")], "house_id bigint, gallery string")
    assert enrich.merge_inner(lst, det).count() == 4
    done = spark.createDataFrame([(1,), (None,)], "house_id bigint")
    assert [r.house_id for r in enrich.pending(lst, done).collect()] == [2]
    u = enrich.append_union(det, lst.select("house_id")).collect()
    assert len(u) == 6


def test_base_info_render(spark):
    df = spark.createDataFrame([("t", 98.0, 12000.0, None, 1e7)],
                               "title string, total_price double, unit_price double, "
                               "community string, house_size double")
    info = df.select(prompt.base_info(df).alias("i")).first().i
    assert info == ("标题: t，区县: -，小区: -，位置: -，总价: 98.0万，单价: 12000.0元/平，户型: -，"
                    "面积: 10000000.0，朝向: -，装修: -，楼层: -，建筑类型: -")


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, "c")], "k int, seq int, v string")
    got = sorted((r.k, r.v) for r in prompt.first_per_key(df, "k", "seq").collect())
    assert got == [(1, "a"), (2, "c")]


def test_prompt_messages(spark):
    final = spark.createDataFrame(
        [(7, 1, "t", [(0, "u1", "户型图")]), (8, 2, "s", [])],
        "house_id bigint, seq bigint, title string, gallery array<struct<pos:int,url:string,descr:string>>")
    wishes = spark.createDataFrame([(1, "  南北通透  "), (2, "   ")], "wish_id bigint, user_input string")
    req = spark.createDataFrame([(7, 1), (8, 2), (9, 1), (7, 1)], "house_id bigint, wish_id bigint")
    imgs = spark.createDataFrame([("u1", bytes.fromhex("FFD8FF"))], "url string, content binary")
    pr = prompt.build_prompts(req, wishes, final, imgs)
    rows = pr.select("house_id", prompt.messages_json("messages").alias("m")).collect()
    assert len(rows) == 3
    got = {r.house_id: r.m for r in rows}
    import json
    m7 = json.loads(got[7])
    assert m7[0]["role"] == "system" and m7[0]["content"][0]["text"] == prompt.SYSTEM_PROMPT
    user = m7[1]["content"]
    assert user[0] == {"type": "text", "text": "# 用户需求\n南北通透"}
    assert user[1]["text"].startswith("# 房源信息\n标题: t，")
    assert user[2] == {"type": "text", "text": "以下是户型图"}
    assert user[3] == {"type": "image_url", "image_url": {"url": "data:image/jpeg;base64,/9j/"}}
    assert user[4] == {"type": "text", "text": "以下是各个房间的图"} and len(user) == 5
    m8 = json.loads(got[8])[1]["content"]
    assert len(m8) == 1 and m8[0]["text"].startswith("# 房源信息\n")
    m9 = json.loads(got[9])[1]["content"]
    assert m9 == [{"type": "text", "text": "# 用户需求\n南北通透"}, {"type": "text", "text": "# 房源信息\n"}]


def test_parse_score(spark):
    df = spark.createDataFrame([("满意分: 85分。根据…",), ("",), ("满意分: 300分",), ("满意分：60",), (None,),
                                ("满意分：**85**分",), ("**满意分**: 70分",)], "r string")
    assert [r.s for r in df.select(score.parse_score("r").alias("s")).collect()] == [85, None, None, 60, None, 85, 70]


def test_reply_batch_with_stub(spark):
    prompts = spark.createDataFrame([(1, 1, "单价: 9001.0元/平"), (2, 1, "nothing")],
                                    "house_id bigint, wish_id bigint, t string") \
        .select("house_id", "wish_id", F.array(F.struct(F.lit("user").alias("role"), F.array(
            prompt.text_part(F.col("t"))).alias("content"))).alias("messages"))
    rows = score.reply_batch(prompts, score.offline_stub).collect()
    out = {r.house_id: (r.reply, r.score) for r in rows}
    assert {r.house_id: r.outcome for r in rows} == {1: "answered", 2: "RuntimeError"}
    assert out[1] == (f"满意分: {9001 % 131}分。{score.STUB_REASON}", 9001 % 131) and out[2] == ("", None)
    answered = spark.createDataFrame([(1, 1)], "house_id bigint, wish_id bigint")
    again = score.reply_batch(prompts, score.offline_stub, answered=answered).collect()
    assert [r.house_id for r in again] == [2]


def test_stage_metrics(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    m = {r.name: r.value for r in metrics.stage_metrics(df, "s", {"total": None, "big": F.col("x") > 1}).collect()}
    assert m == {"total": 3, "big": 2}


def test_gallery_follows_html_parser_semantics(spark):
    html = ('<ul class="a smallpic b">'
            '<li data-desc="A&amp;B"><img class="lazy"><img src="http://i/x.jpg"></li>'  # first img has no src
            '<li data-desc="户型图"><img src="http://i/y.jpg?a=1&amp;b=2"></li></ul>')
    df = spark.createDataFrame([(1, "l", html)], "house_id bigint, link string, html string")
    g = gallery.extract_details(df).first().gallery
    assert [(e.url, e.descr) for e in g] == [("http://i/y.jpg?a=1&b=2", "户型图")]


def test_card_marker_any_tag_any_attribute_order(spark):
    c = fx.card(house_id="5")
    html = fx.page(c.replace('<div class="info clear">', '<section data-x="1" class="info clear">'),
                   c.replace('<div class="info clear">', '<div class="clear info">'))
    got = [r.house_id for r in extract.kept(extract.extract_listings(pages_df(spark, html))).collect()]
    assert got == [5]


def test_profiles_one_pass(spark):
    df = spark.createDataFrame(
        [("高", 1, 13000.0, 1), ("高", 1, 13000.0, 0), ("中高", 1, 12500.5, 1), ("低", 0, 9000.0, 0)],
        "level string, f1 int, unit double, f2 int")
    out = screen.profiles(df, {"level": ("f1", "level"), "unit": ("f2", "unit")}, top={"level": 1})
    got = sorted((r.profile, r.value, r.n, r.rank) for r in out.collect())
    assert got == [("level", "高", 2, 1), ("unit", "12500.5", 1, None), ("unit", "13000.0", 1, None)]


def test_gallery_attribute_forms(spark):
    html = ('<ul class="smallpic">'
            "<li data-desc='卧室'><img data-src=\"lazy.gif\" SRC='http://i/a.jpg'></li>"
            '<li DATA-DESC=厨房><img src=http://i/b.jpg alt=x></li></ul>')
    df = spark.createDataFrame([(1, "l", html)], "house_id bigint, link string, html string")
    g = gallery.extract_details(df).first().gallery
    assert [(e.url, e.descr) for e in g] == [("http://i/a.jpg", "卧室"), ("http://i/b.jpg", "厨房")]


def test_cards_with_nested_lists_and_single_quotes(spark):
    c = fx.card(house_id="5").replace('<div class="priceInfo">', '<ul><li>a</li><li>b</li></ul><div><div>x</div></div><div class="priceInfo">')
    html = fx.page(c, fx.card(house_id="6").replace('<div class="info clear">', "<div class='info clear'>"), fx.card(house_id="7"))
    got = extract.kept(extract.extract_listings(pages_df(spark, html))).orderBy("seq").collect()
    assert [(r.house_id, r.total_price, r.seq) for r in got] == [(5, 560.0, 0), (6, 560.0, 1), (7, 560.0, 2)]


def test_card_ends_with_its_own_element(spark):
    bare = '<div class="info clear"><a data-housecode="1"></a></div>'
    html = bare + '<div class="totalPrice totalPrice2"><i> </i><span class="">5</span><i>万</i></div>'
    card = extract.explode_cards(pages_df(spark, html)).first().card
    assert card == '<a data-housecode="1"></a>'


def test_gallery_with_nested_lists(spark):
    html = ('<ul class=\'x smallpic\'><li data-desc="A"><ul><li data-desc="B"><img src="http://i/1.jpg"></li></ul><img src="http://i/2.jpg"></li>'
            '<LI data-desc="C"><IMG SRC="http://i/3.jpg"></LI></ul><ul class="smallpic"><li><img src="later.jpg"></li></ul>')
    df = spark.createDataFrame([(1, "l", html)], "house_id bigint, link string, html string")
    g = gallery.extract_details(df).first().gallery
    # an outer item's first picture is the nested one; the nested item names it last
    assert [(e.url, e.descr) for e in g] == [("http://i/1.jpg", "B"), ("http://i/3.jpg", "C")]


def test_element_text(spark):
    from hearth.functions.html import element_text
    cases = [("a</div>b", "a"), ("<div>x</div>y</div>z", "<div>x</div>y"), ("<divx></div>", "<divx>"), ("open <DIV>no end", "open <DIV>no end"),
             ("</div>", ""), ("", ""), ("<div><div></div></DIV >t</div>u", "<div><div></div></DIV >t")]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, s string")
    assert [r.t for r in df.select("i", element_text("s", "div").alias("t")).orderBy("i").collect()] == [b for _, b in cases]


def test_attach_images_landed_twice_and_shared_by_many(spark):
    pics = [(0, "hot", "户型图"), (1, "a", "户型图"), (2, "none", "客厅"), (3, "b", "客厅")]
    det = spark.createDataFrame([(i, pics) for i in range(500)], "house_id bigint, gallery array<struct<pos:int,url:string,descr:string>>")
    imgs = spark.createDataFrame([("hot", b"1"), ("hot", b"1"), ("a", b"2"), ("a", b"3"), ("b", None), ("b", b"4"), ("unused", b"5")], "url string, content binary")
    rows = gallery.attach_images(det, imgs).collect()
    assert len(rows) == 500 and all(len(r.plan_uris) == 2 and len(r.room_uris) == 1 for r in rows)
    assert rows[0].plan_uris[1].endswith("Mg==")  # of two versions the least bytes
    bare = spark.createDataFrame([(1, "i", []), (2, "j", None)], "house_id bigint, info string, gallery array<struct<pos:int,url:string,descr:string>>")
    kept = gallery.attach_images(bare, imgs, carry=("info", "gallery")).orderBy("house_id").collect()
    assert [(r.house_id, r.info, r.plan_uris, r.room_uris) for r in kept] == [(1, "i", [], []), (2, "j", [], [])]


def test_page_cap_and_landed_pages(spark):
    df = spark.createDataFrame([("a", 3100), ("b", 2900), ("c", 0)], "district_en string, house_num bigint")
    out = extract.page_frontier(df)
    assert {(r.district_en, r.beyond_cap) for r in out.collect()} == {("a", 100), ("b", 0)}
    assert out.count() == 100 + 97 and extract.page_frontier(df, cap=None).count() == 104 + 97
    landed = spark.createDataFrame([("https://hd.example.com/ershoufang/a/pg7",), ("https://hd.example.com/ershoufang/a/pg7/",), (None,)], "url string")
    got = extract.frontier_status(out, landed).filter("landed").collect()
    assert [(r.district_en, r.page) for r in got] == [("a", 7)]


def test_listing_views_limit(spark):
    final = spark.createDataFrame([(7, 1, "t", [(i, f"u{i}", "户型图") for i in range(12)])],
                                  "house_id bigint, seq bigint, title string, gallery array<struct<pos:int,url:string,descr:string>>")
    assert len(prompt.listing_view(final, 7).first().plan_urls) == 8
    assert len(prompt.listing_view(final, 7, max_num=3).first().plan_urls) == 3
    assert prompt.listing_view(final, 8).count() == 0


def test_hot_images_are_split_and_cold_ones_travel_once(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        row = F.array(*[F.struct(F.lit(i).alias("pos"), u.alias("url"), F.lit("客厅").alias("descr"))
                        for i, u in enumerate([F.lit("hot"), F.concat(F.lit("u"), (F.col("id") % 997).cast("string"))])])
        det = spark.range(0, 20_000, 1, 8).select(F.col("id").alias("house_id"), row.alias("gallery"))
        imgs = spark.range(997).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), F.unhex(F.lit("FFD8FF")).alias("content")).unionByName(
            spark.createDataFrame([("hot", b"h")], "url string, content binary"))
        out = gallery.attach_images(det, imgs)
        got = out.selectExpr("count(1) n", "sum(size(room_uris)) m").first()
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert (got.n, got.m) == (20_000, 40_000)
    final = plan.split("Initial Plan")[0]
    assert "skew=true" in final, final           # the hot partition is split
    assert final.count("Generate explode") == 1  # galleries are opened once, each image meets them as it is


def test_price_bands(spark):
    import random
    rnd = random.Random(3)
    rows = [("a", float(rnd.randint(0, 5000)) + 0.5) for _ in range(3000)] + [("b", 10.0)] * 250 + [("c", 1.0), ("c", -5.0), ("c", 1e15), ("c", None), (None, 3.0), ("c", float("nan"))]
    out = extract.price_bands(spark.createDataFrame(rows, "d string, p double"), "d", "p", cap=100).collect()
    a = sorted((r.lo, r.hi, r.n) for r in out if r.d == "a")
    assert all(n <= 100 for *_, n in a) and sum(n for *_, n in a) == 3000
    assert all(x[1] < y[0] for x, y in zip(a, a[1:]))
    assert all(sum(lo <= p < hi + 1 for d, p in rows if d == "a") == n for lo, hi, n in a)
    assert [(r.lo, r.hi, r.n, r.beyond_cap) for r in out if r.d == "b"] == [(10, 10, 250, 150)]
    assert [(r.lo, r.hi, r.n) for r in out if r.d == "c"] == [(0, 2 ** 32 - 1, 3)]
    pages = extract.banded_frontier(spark.createDataFrame([("x", 0, 7, 61, 0)], "district_en string, lo long, hi long, n long, beyond_cap long"))
    assert [r.url for r in pages.orderBy("page").collect()] == [f"https://hd.example.com/ershoufang/x/p0-7/pg{i}/" for i in (1, 2, 3)]


def test_sketches_of_days_combine(spark, scratch):
    df = spark.range(30_000).select((F.pmod(F.xxhash64("id"), F.lit(60)) * F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4))).alias("v"), (F.col("id") % 7).cast("string").alias("dt"))
    df = df.withColumn("v", F.when(F.col("v") > 0, F.col("v")))
    screen.daily_sketches(df, "v").write.parquet(f"{scratch}/sketches")        # kept per day
    kept = spark.read.parquet(f"{scratch}/sketches")
    for days in (["0"], ["1", "4"], [str(d) for d in range(7)]):
        exact = screen.value_counts(df.filter(F.col("dt").isin(days)), "v", top=10).collect()
        got = screen.combined_top(kept.filter(F.col("dt").isin(days)), "v").collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in exact]
    many = spark.range(200_000).select(F.when(F.col("id") % 4 == 0, F.col("id") % 5).otherwise(F.col("id")).alias("v"), F.lit("d").alias("dt"))
    off = screen.combined_top(screen.daily_sketches(many, "v", capacity=1000), "v", top=5, capacity=1000).collect()
    assert {r.v for r in off} == {0, 1, 2, 3, 4} and all(0 <= r.n - 10_000 <= 3.5 * 200_000 / 2048 for r in off)
