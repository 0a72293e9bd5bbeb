"""End-to-end jobs over stage tables in a scratch folder, CSV exchange, streaming landing."""

import os

from pyspark.sql import functions as F

from hearth import schema
from hearth.operators import score
from hearth.plans import jobs
from hearth.sources import files, regions
from hearth.streaming import landing
from tests import fixtures as fx

DT = "20250508"


def list_pages(spark):
    p1 = fx.page(fx.card(house_id="11", total="98", unit="11000"),
                 fx.card(house_id="12", facts="2室1厅 | 60平米 | 南 | 精装 | 低楼层"),
                 fx.card(house_id="13", total="150", unit="9000",
                         facts="3室1厅 | 120平米 | 南 北 | 简装 | 中楼层(共6层) | 板楼"))
    p2 = fx.page(fx.card(house_id="14", total="80", unit="9500",
                         facts="1室1厅 | 45平米 | 东 | 精装 | 低楼层(共6层) | 塔楼"),
                 fx.card(house_id="11", total="98", unit="11000",
                         facts="2室1厅 | 89.5平米 | 南 北 | 精装 | 中楼层(共18层) | 板楼"))
    p3 = fx.page(fx.card(house_id="99", total="10", unit="10"))
    rows = [(0, "https://x/ershoufang/congtaiqu/pg1/", p1),
            (1, "https://x/ershoufang/congtaiqu/pg2/", p2),
            (2, "https://x/ershoufang/wudaokou/pg1/", p3)]   # not a district of 'hd'
    return spark.createDataFrame(rows, schema.PAGES)


def detail_pages(spark):
    rows = [(11, "l11", fx.detail_page([("户型图", "http://i/a.120x80.jpg"), ("客厅", "http://i/b.120x80.jpg")])),
            (14, "l14", fx.detail_page([], with_gallery=False))]
    return spark.createDataFrame(rows, "house_id bigint, link string, html string")


def test_jobs_end_to_end(spark, scratch):
    root = os.path.join(scratch, "stages")
    m = {r.name: r.value for r in jobs.collect(spark, list_pages(spark), root, DT).collect()}
    assert m == {"pages": 3, "unrecognised_pages": 1, "out_of_scope_pages": 0, "total_num": 5, "err_num": 1}
    assert files.read_stage(spark, root, "rejects", dt=DT).first().reject_reason == "short_facts"
    listings = files.read_stage(spark, root, "listings", dt=DT)
    assert sorted(r.house_id for r in listings.collect()) == [11, 11, 13, 14]
    assert {r.district for r in listings.collect()} == {"丛台区"}

    prof = {(r.profile, r.value, r.n, r.rank) for r in jobs.screen_stage(spark, root, DT).collect()}
    assert prof == {("level", "高楼层(共18层)", 1, 1), ("total_price", "150.0", 1, None)}
    screened = files.read_stage(spark, root, "screened", dt=DT)
    assert sorted(r.house_id for r in screened.collect()) == [11, 14]

    dm = {r.name: r.value for r in jobs.details_stage(spark, root, DT, detail_pages(spark)).collect()}
    assert dm == {"pages": 2, "found": 1, "missing": 1, "failed": 0}
    # resume: a second run fetches only what is still missing and adds nothing
    jobs.details_stage(spark, root, DT, detail_pages(spark))
    assert files.read_stage(spark, root, "details", dt=DT).count() == 1

    jobs.merge_stage(spark, root, DT)
    final = files.read_stage(spark, root, "final", dt=DT)
    assert final.count() == 1 and final.first().gallery[0].url == "http://i/a.450x300.jpg"

    wishes = spark.createDataFrame([(1, "两居")], schema.WISHES)
    req = spark.createDataFrame([(11, 1), (14, 1)], schema.REQUESTS)
    imgs = spark.createDataFrame([("http://i/a.450x300.jpg", bytes.fromhex("FFD8FF00"))], schema.IMAGES)
    jobs.prompts_stage(spark, root, DT, req, wishes, imgs)
    replies = jobs.replies_stage(spark, root, DT, score.offline_stub)
    got = {r.house_id: r.score for r in replies.collect()}
    # 11: unit price 11000 -> 11000 % 131 = 127 (> 100: no score); 14 is not in final
    assert got == {11: None, 14: None}
    n_before = files.read_stage(spark, root, "replies", dt=DT).count()
    jobs.replies_stage(spark, root, DT, score.offline_stub)   # only '' replies are asked again
    assert files.read_stage(spark, root, "replies", dt=DT).count() == n_before + 1

    groups, shortlisted = jobs.shortlist_stage(spark, root, DT, min_score=0)
    assert groups.count() == 0 and shortlisted.count() == 0
    got = [(r.stage, r.name, r.value) for r in jobs.read_metrics(spark, root, DT).collect()]
    assert {s for s, _, _ in got} == {"collect", "screen", "details", "merge", "prompts", "replies"}
    # both runs asked: 11 is answered by the first, 14 fails in both
    assert sorted((n, v) for s, n, v in got if s == "replies") == [
        ("answered", 0), ("answered", 1), ("asked", 1), ("asked", 2), ("failed", 1), ("failed", 1)]


def test_region_scope(spark):
    assert [r.district_en for r in regions.districts(spark, "hd", "small").collect()] == ["congtaiqu"]
    assert regions.districts(spark, "hd", "other").count() == 4
    assert regions.districts(spark, "hz", "small").count() == 0
    try:
        regions.districts(spark, "xx")
        raise AssertionError("unknown city accepted")
    except ValueError:
        pass


def test_csv_exchange_legacy_names_and_bom(spark, scratch):
    path = os.path.join(scratch, "dt.csv")
    with open(path, "w", encoding="utf-8-sig") as fh:
        fh.write(",house_id,title,total_price,unit_price,hourse_type,hourse_size,level\n")
        fh.write('0,101,"a ""quoted"", title",98.0,12000.0,2室1厅,89.5,高楼层\n')
        fh.write("1,102,b,-,x,1室,nan?,\n")
    df = files.read_csv_table(spark, path, schema.LISTINGS)
    rows = df.orderBy("house_id").collect()
    assert rows[0].title == 'a "quoted", title' and rows[0].house_type == "2室1厅"
    assert rows[0].house_size == 89.5 and rows[1].total_price is None
    out = os.path.join(scratch, "out")
    files.write_csv_table(df.select("house_id", "title"), out)
    back = files.read_csv_table(spark, out, schema.LISTINGS).orderBy("house_id").first()
    assert back.title == 'a "quoted", title'


def test_streaming_landing(spark, scratch):
    land = os.path.join(scratch, "landing")
    root = os.path.join(scratch, "stages")
    detail_pages(spark).write.parquet(os.path.join(land, "batch=1"))
    landing.start_landing(spark, land, root, DT).awaitTermination(120)
    assert files.read_stage(spark, root, "details", dt=DT).count() == 1
    # the same pages landing again add nothing
    detail_pages(spark).write.parquet(os.path.join(land, "batch=2"))
    landing.start_landing(spark, land, root, DT).awaitTermination(120)
    assert files.read_stage(spark, root, "details", dt=DT).count() == 1
    assert files.read_stage(spark, root, "details", dt=DT).select(F.col("gallery")[0]["url"]).first()[0] \
        == "http://i/a.450x300.jpg"
    m = files.read_stage(spark, root, "metrics", dt=DT).filter(F.col("stage") == "landing/0")
    assert {(r.name, r.value) for r in m.collect()} == {
        ("pages", 2), ("found", 1), ("missing", 1), ("failed", 0)}


def test_csv_export_starts_with_bom(spark, scratch):
    out = os.path.join(scratch, "bom")
    df = spark.createDataFrame([(1, "南北")], "house_id bigint, title string")
    files.write_csv_table(df.coalesce(1), out)
    part = [f for f in os.listdir(out) if f.startswith("part-")][0]
    with open(os.path.join(out, part), "rb") as fh:
        assert fh.read().startswith("\ufeffhouse_id,title\n".encode("utf-8"))
    back = files.read_csv_table(spark, out, schema.LISTINGS).first()
    assert (back.house_id, back.title) == (1, "南北")


def test_dated_snapshots_replace_only_their_day(spark, scratch):
    root = os.path.join(scratch, "stages")
    a = spark.createDataFrame([(1, "20250101"), (2, "20250102")], "house_id bigint, dt string")
    files.write_stage(a, root, "listings")
    files.write_stage(spark.createDataFrame([(3, "20250102")], "house_id bigint, dt string"), root, "listings")
    got = sorted((r.house_id, r.dt) for r in files.read_stage(spark, root, "listings").collect())
    assert got == [(1, "20250101"), (3, "20250102")]
    assert files.snapshot_date(__import__("datetime").date(2025, 5, 8)) == "20250508"


def test_read_images(spark, scratch):
    land = os.path.join(scratch, "imgs", "p")
    os.makedirs(land)
    with open(os.path.join(land, "a.450x300.jpg"), "wb") as fh:
        fh.write(bytes.fromhex("FFD8FF00"))
    df = files.read_images(spark, os.path.join(scratch, "imgs"), url_root="http://i")
    r = df.first()
    assert r.url == "http://i/p/a.450x300.jpg" and bytes(r.content) == bytes.fromhex("FFD8FF00")


def test_debug_caps(spark, scratch):
    from hearth.operators import enrich, preview
    root = os.path.join(scratch, "stages")
    m = {r.name: r.value for r in jobs.collect(spark, list_pages(spark), root, DT, debug=True).collect()}
    assert m == {"pages": 3, "unrecognised_pages": 1, "out_of_scope_pages": 0, "total_num": 3, "err_num": 1}  # first page of each district only
    cands = spark.createDataFrame([(5, 50), (4, 40), (6, 60)], "house_id bigint, seq bigint")
    done = spark.createDataFrame([(4,)], "house_id bigint")
    assert [r.house_id for r in enrich.resume_batch(cands, done, limit=1).collect()] == [5]
    assert [r.house_id for r in preview.first_n(cands, 2).collect()] == [4, 5]


def test_listing_views(spark):
    from hearth.operators import prompt
    final = spark.createDataFrame(
        [(7, 2, "t2", []), (7, 1, "t1", [(0, "a.450x300.jpg", "户型图"), (1, "b.450x300.jpg", "客厅")])],
        "house_id bigint, seq bigint, title string, gallery array<struct<pos:int,url:string,descr:string>>")
    req = spark.createDataFrame([(7,), (7,), (8,)], "house_id bigint")
    rows = prompt.listing_views(req, final).collect()
    assert len(rows) == 1 and rows[0].info.startswith("标题: t1，")
    assert rows[0].plan_urls == ["a.210x140.jpg"] and rows[0].room_urls == ["b.210x140.jpg"]


def test_cli_steps(spark, scratch, capsys):
    from hearth import cli
    pages = os.path.join(scratch, "pages")
    details = os.path.join(scratch, "details")
    list_pages(spark).write.parquet(pages)
    detail_pages(spark).write.parquet(details)
    req, wishes = os.path.join(scratch, "req"), os.path.join(scratch, "wishes")
    spark.createDataFrame([(11, 1)], schema.REQUESTS).write.parquet(req)
    spark.createDataFrame([(1, "两居")], schema.WISHES).write.parquet(wishes)
    root = os.path.join(scratch, "stages")
    base = ["--root", root, "--dt", DT]
    assert cli.main(base + ["collect", "--pages", pages, "--city_name", "hd"]) == 0
    for step in (["screen"], ["details", "--detail_pages", details], ["merge"],
                 ["prompts", "--requests", req, "--wishes", wishes], ["score"], ["shortlist"]):
        assert cli.main(base + step) == 0
    assert files.read_stage(spark, root, "replies", dt=DT).count() == 1
    capsys.readouterr()
    cli.main(base + ["prompts", "--user_input", "两居"])
    assert files.read_stage(spark, root, "prompts", dt=DT).count() == 1
    shortlist = os.path.join(scratch, "shortlist")
    cli.main(base + ["shortlist", "--out", shortlist])
    assert {"groups", "listings"} <= set(os.listdir(shortlist))
    capsys.readouterr()
    cli.main(base + ["ask", "--house_id", "11", "--user_input", " 两居 "])
    assert "满意分: 127分" in capsys.readouterr().out
    out = os.path.join(scratch, "final_csv")
    cli.main(base + ["export", "--stage", "final", "--out", out])
    assert any(f.startswith("part-") for f in os.listdir(out))


def test_cli_import_and_export_text_galleries(spark, scratch):
    from hearth import cli
    root = os.path.join(scratch, "stages")
    det_csv = os.path.join(scratch, "dt_20250508_cut_details.csv")
    with open(det_csv, "w", encoding="utf-8") as fh:
        fh.write("house_id,link,urls,url_dict\n")
        fh.write("11,l11,u1;u2,u1##户型图;u2##客厅\n")
        fh.write("14,l14,,\n")
    lst_csv = os.path.join(scratch, "dt_20250508_cut.csv")
    with open(lst_csv, "w", encoding="utf-8-sig") as fh:
        fh.write(",house_id,title,total_price,unit_price,hourse_type,hourse_size,level,"
                 "is_high_level,is_unit_price_high,is_total_price_high\n")
        fh.write("0,11,a,98.0,11000.0,2室1厅,89.5,低楼层,0,0,0\n")
        fh.write("1,14,b,80.0,9500.0,1室1厅,45.0,中楼层,0,0,0\n")
    base = ["--root", root, "--dt", DT]
    cli.main(base + ["import", "--stage", "details", "--csv", det_csv])
    cli.main(base + ["import", "--stage", "screened", "--csv", lst_csv])
    det = {r.house_id: r.gallery for r in files.read_stage(spark, root, "details", dt=DT).collect()}
    assert [(e.url, e.descr) for e in det[11]] == [("u1", "户型图"), ("u2", "客厅")] and det[14] == []
    scr = files.read_stage(spark, root, "screened", dt=DT).orderBy("seq").collect()
    assert [r.house_type for r in scr] == ["2室1厅", "1室1厅"]
    cli.main(base + ["merge"])
    out = os.path.join(scratch, "final_csv")
    cli.main(base + ["export", "--stage", "final", "--out", out])
    back = spark.read.option("header", True).csv(out).orderBy("house_id").collect()
    assert back[0]["url_dict"] == "u1##户型图;u2##客厅" and back[1]["url_dict"] is None


def test_intermediate_tables_are_removed(spark, scratch):
    from hearth.session import checkpoint_root
    root = os.path.join(scratch, "stages")
    jobs.collect(spark, list_pages(spark), root, DT)
    tables = os.path.join(checkpoint_root(spark).replace("file:", ""), "tables")
    assert not os.path.isdir(tables) or os.listdir(tables) == []


def test_dt_stays_text_with_type_inference_on(spark, scratch):
    root = os.path.join(scratch, "stages")
    files.write_stage(spark.createDataFrame([(1, DT)], "house_id bigint, dt string"), root, "listings")
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    spark.conf.set(key, "true")
    try:
        df = files.read_stage(spark, root, "listings", dt=DT)
        assert dict(df.dtypes)["dt"] == "string" and df.count() == 1
    finally:
        spark.conf.set(key, "false")


def test_rerun_counters_are_told_apart(spark, scratch):
    root = os.path.join(scratch, "stages")
    jobs.collect(spark, list_pages(spark), root, DT)
    jobs.screen_stage(spark, root, DT)
    first = {(r.name, r.value) for r in jobs.details_stage(spark, root, DT, detail_pages(spark)).collect()}
    again = {(r.name, r.value) for r in jobs.details_stage(spark, root, DT, detail_pages(spark)).collect()}
    assert first == {("pages", 2), ("found", 1), ("missing", 1), ("failed", 0)}
    assert again == {("pages", 1), ("found", 0), ("missing", 1), ("failed", 0)}
    runs = {r.run for r in jobs.read_metrics(spark, root, DT).filter("stage = 'details'").collect()}
    assert len(runs) == 2


def stored(spark, root, stage, rows, schema_of=None):
    files.write_stage(spark.createDataFrame(rows, schema_of or schema.STAGES[stage]), root, stage, DT)


def listing(house_id, total=98.0, unit=11000.0, level="低楼层", seq=0):
    return (house_id, "t", "d", "c", "p", "-", total, unit, "l", "2室1厅", 80.0, "南", "精装", level, "板楼", seq, DT)


def test_nothing_flagged_and_nothing_kept(spark, scratch):
    root = os.path.join(scratch, "stages")
    stored(spark, root, "listings", [listing(1)])
    assert jobs.screen_stage(spark, root, DT).count() == 0          # no listing is flagged
    assert files.read_stage(spark, root, "screened", dt=DT).count() == 1
    stored(spark, root, "listings", [listing(1, total=500.0)])
    assert jobs.screen_stage(spark, root, DT).count() == 1          # none passes: the earlier answer goes
    assert files.read_stage(spark, root, "screened", dt=DT).count() == 0
    jobs.details_stage(spark, root, DT, detail_pages(spark))
    jobs.merge_stage(spark, root, DT)
    assert files.read_stage(spark, root, "final", dt=DT).count() == 0


def test_rerun_without_rows_replaces_the_day(spark, scratch):
    root = os.path.join(scratch, "stages")
    jobs.collect(spark, list_pages(spark), root, DT)
    files.write_stage(files.read_stage(spark, root, "listings", dt=DT).limit(1), root, "listings", "20250509")
    jobs.collect(spark, list_pages(spark).limit(0), root, DT)
    assert files.read_stage(spark, root, "listings", dt=DT).count() == 0
    assert files.read_stage(spark, root, "listings", dt="20250509").count() == 1


def test_unreadable_replies_make_no_call(spark, scratch, monkeypatch):
    root = os.path.join(scratch, "stages")
    stored(spark, root, "final", [listing(11)[:-1] + (0, 0, 0, [])])
    jobs.prompts_stage(spark, root, DT, spark.createDataFrame([(11, 1)], schema.REQUESTS),
                       spark.createDataFrame([(1, "w")], schema.WISHES))
    path = files.stage_path(root, "replies")
    os.makedirs(f"{path}/dt={DT}")
    with open(f"{path}/dt={DT}/part-0.parquet", "wb") as fh:
        fh.write(b"not parquet")
    called = os.path.join(scratch, "called")

    def factory():
        open(called, "w").close()
        return score.offline_stub()
    try:
        jobs.replies_stage(spark, root, DT, factory)
        raise AssertionError("a broken reply table was taken for an empty one")
    except AssertionError:
        raise
    except Exception:
        assert not os.path.exists(called)


def test_read_stage_if_any_hides_only_a_missing_path(spark, scratch):
    import pytest
    assert files.read_stage_if_any(spark, os.path.join(scratch, "none"), "details").count() == 0
    with pytest.raises(Exception, match="nosuchscheme"):
        files.read_stage_if_any(spark, "nosuchscheme://x", "details").count()


def test_merge_keeps_bag_semantics(spark, scratch):
    root = os.path.join(scratch, "stages")
    stored(spark, root, "screened", [listing(1, seq=0) + (0, 0, 0), listing(1, seq=1) + (0, 0, 0)])
    stored(spark, root, "details", [(1, "a", []), (1, "b", [(0, "u", "x")])])
    jobs.merge_stage(spark, root, DT)
    assert files.read_stage(spark, root, "final", dt=DT).count() == 4


def test_collect_counts_pages_left_out(spark, scratch):
    root = os.path.join(scratch, "stages")
    page = fx.page(fx.card(house_id="11", facts="2室1厅 | 60平米 | 南 | 精装 | 低楼层 | 板楼"))
    urls = ["https://x/ershoufang/congtaiqu/", "https://x/ershoufang/fuxingqu/pg1", "https://x/other/", None]
    df = spark.createDataFrame([(i, u, page) for i, u in enumerate(urls)], schema.PAGES)
    m = {r.name: r.value for r in jobs.collect(spark, df, root, DT, area_name="small").collect()}
    assert m == {"pages": 4, "unrecognised_pages": 2, "out_of_scope_pages": 1, "total_num": 1, "err_num": 0}
    given = df.withColumn("district", F.lit("复兴区"))
    m = {r.name: r.value for r in jobs.collect(spark, given, root, DT, area_name="small").collect()}
    assert (m["out_of_scope_pages"], m["total_num"]) == (4, 0)
    assert files.read_stage(spark, root, "listings", dt=DT).count() == 0
    m = {r.name: r.value for r in jobs.collect(spark, given, root, DT).collect()}
    assert m["total_num"] == 4 and {r.district for r in files.read_stage(spark, root, "listings", dt=DT).collect()} == {"复兴区"}


def test_shortlist_is_written(spark, scratch):
    root = os.path.join(scratch, "stages")
    stored(spark, root, "final", [listing(1, unit=9001.0)[:-1] + (0, 0, 0, []), listing(2, unit=20.0)[:-1] + (0, 0, 0, [])])
    jobs.prompts_stage(spark, root, DT, *jobs.score_all_requests(spark, root, DT, "两居"))
    jobs.replies_stage(spark, root, DT, score.offline_stub)
    groups, listings = jobs.shortlist_stage(spark, root, DT, min_score=90)
    assert [(r.house_id, r.score) for r in listings.collect()] == [(1, 9001 % 131)]  # 93
    assert [(r.n_listings, r.max_score) for r in groups.collect()] == [(1, 93)]
    jobs.shortlist_stage(spark, root, DT, min_score=95)
    assert files.read_stage(spark, root, "shortlist", dt=DT).count() == 0


def test_csv_without_line_breaks_and_import_order(spark, scratch):
    from hearth import cli
    path = os.path.join(scratch, "csv")
    os.makedirs(path)
    for k in (2, 0, 1):
        with open(os.path.join(path, f"part-{k}.csv"), "w", encoding="utf-8") as fh:
            fh.write("house_id,title\n" + "".join(f"{100 * k + i},t\n" for i in range(20 if k else 3000)))
    df = cli.import_csv(spark, "listings", path)
    assert [r.house_id for r in df.orderBy("seq").collect()] == list(range(3000)) + [100 + i for i in range(20)] + [200 + i for i in range(20)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        plain = files.read_csv_table(spark, path, schema.LISTINGS, newlines=False)
        assert plain.count() == 3040 and plain.rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
