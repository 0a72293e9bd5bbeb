"""Command line for the stage jobs: ``python -m hearth.cli <step> ...``.

Steps mirror a listing run: collect, screen, details, merge, prompts, score,
shortlist, ask (one listing, one wish), export (a stage as CSV).  Every step
reads and writes stage tables under ``--root`` for the snapshot ``--dt``.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from hearth import schema
from hearth.operators import extract, score
from hearth.plans import jobs
from hearth.sources import files


def _factory(spec: str) -> score.ClientFactory:
    """'module:function' returning a client; 'offline' for the deterministic stub."""
    if spec == "offline":
        return score.offline_stub
    mod, _, fn = spec.partition(":")
    return getattr(importlib.import_module(mod), fn)


def _session() -> SparkSession:
    return SparkSession.builder.appName("hearth").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="hearth")
    p.add_argument("--root", required=True, help="stage root folder (shared storage)")
    p.add_argument("--dt", default=files.snapshot_date(), help="snapshot date yyyyMMdd")
    sub = p.add_subparsers(dest="step", required=True)

    c = sub.add_parser("collect", help="landed list pages -> listings + rejects")
    c.add_argument("--pages", required=True, help="parquet of (page_id, url, html[, district])")
    c.add_argument("--city_name", default="bj")
    c.add_argument("--area_name", default="all")
    c.add_argument("--site_root", default=extract.Site().root)
    c.add_argument("--debug", type=int, default=0, help="1: first page of each district only")

    sub.add_parser("screen", help="listings -> screened and profiles (frequency tables)")

    d = sub.add_parser("details", help="landed detail pages -> details (resumable)")
    d.add_argument("--detail_pages", required=True, help="parquet of (house_id, link, html)")
    d.add_argument("--debug_num", type=int, default=0)

    sub.add_parser("merge", help="screened x details -> final")

    pr = sub.add_parser("prompts", help="requests x wishes -> prompts")
    pr.add_argument("--user_input", default=None, help="one wish: every listing is scored for it")
    pr.add_argument("--requests", help="parquet of (house_id, wish_id)")
    pr.add_argument("--wishes", help="parquet of (wish_id, user_input)")
    pr.add_argument("--images", default=None, help="folder of landed image files")
    pr.add_argument("--image_url_root", default=None)
    pr.add_argument("--check_images", action="store_true", help="leave out images that are cut off or damaged")

    s = sub.add_parser("score", help="prompts -> replies through a model client")
    s.add_argument("--client", default="offline", help="module:function returning a client")
    s.add_argument("--concurrency", type=int, default=None)
    s.add_argument("--in_flight", type=int, default=4)

    sl = sub.add_parser("shortlist", help="qualifying communities and layouts")
    sl.add_argument("--min_score", type=int, default=score.SHORTLIST_MIN_SCORE)
    sl.add_argument("--out", default=None, help="folder for the shortlist as CSV")

    a = sub.add_parser("ask", help="score one listing against one wish")
    a.add_argument("--house_id", type=int, required=True)
    a.add_argument("--user_input", default="")
    a.add_argument("--client", default="offline")
    a.add_argument("--images", default=None, help="folder of landed image files")
    a.add_argument("--image_url_root", default=None)

    e = sub.add_parser("export", help="write a stage as CSV (galleries as urls / url_dict text)")
    e.add_argument("--stage", required=True, choices=files.STAGES)
    e.add_argument("--out", required=True)

    im = sub.add_parser("import", help="load a stage from CSV files of an earlier run")
    im.add_argument("--stage", required=True, choices=("listings", "screened", "details", "final"))
    im.add_argument("--csv", required=True)

    args = p.parse_args(argv)
    spark = _session()
    root, dt = args.root, args.dt

    if args.step == "collect":
        pages = files.read_pages(spark, args.pages)
        site = extract.Site(root=args.site_root, city=args.city_name)
        jobs.collect(spark, pages, root, dt, args.city_name, args.area_name, site,
                     debug=bool(args.debug)).show(truncate=False)
    elif args.step == "screen":
        _print_all(jobs.screen_stage(spark, root, dt).drop("dt").orderBy("profile", F.desc("n"), "value"))
    elif args.step == "details":
        jobs.details_stage(spark, root, dt, spark.read.parquet(args.detail_pages),
                           args.debug_num).show(truncate=False)
    elif args.step == "merge":
        jobs.merge_stage(spark, root, dt)
    elif args.step == "prompts":
        imgs = files.read_images(spark, args.images, args.image_url_root) if args.images else None
        if args.user_input is not None:
            requests, wishes = jobs.score_all_requests(spark, root, dt, args.user_input)
        elif args.requests and args.wishes:
            requests, wishes = spark.read.parquet(args.requests), spark.read.parquet(args.wishes)
        else:
            p.error("prompts needs --user_input, or --requests and --wishes")
        jobs.prompts_stage(spark, root, dt, requests, wishes, imgs, args.check_images)
    elif args.step == "score":
        jobs.replies_stage(spark, root, dt, _factory(args.client), args.concurrency,
                           args.in_flight).groupBy(F.col("score").isNotNull().alias("scored")) \
            .count().show()
    elif args.step == "shortlist":
        groups, listings = jobs.shortlist_stage(spark, root, dt, args.min_score)
        if args.out:
            files.write_csv_table(groups.drop("dt"), f"{args.out.rstrip('/')}/groups")
            files.write_csv_table(listings.drop("dt"), f"{args.out.rstrip('/')}/listings")
        else:
            _print_all(groups.drop("dt").orderBy(F.desc("max_score"), "wish_id", "community", "house_type"))
            _print_all(listings.select("wish_id", "house_id", "score", "title", "community", "link")
                       .orderBy("wish_id", F.desc("score"), "house_id"))
    elif args.step == "ask":
        req = spark.createDataFrame([(args.house_id, 0)], schema.REQUESTS)
        wish = spark.createDataFrame([(0, args.user_input)], schema.WISHES)
        final = files.read_stage(spark, root, "final", dt=dt)
        from hearth.operators import prompt
        imgs = files.read_images(spark, args.images, args.image_url_root) if args.images else None
        prompts = prompt.build_prompts(req, wish, final, imgs)
        for r in score.reply_batch(prompts, _factory(args.client)).collect():
            print(r.reply)
    elif args.step == "export":
        df = files.read_stage(spark, root, args.stage, dt=dt)
        if "gallery" in df.columns:
            df = gallery_as_text(df)
        files.write_csv_table(df.drop("dt"), args.out)
    elif args.step == "import":
        files.write_stage(import_csv(spark, args.stage, args.csv), root, args.stage, dt)
    return 0


def _print_all(df) -> None:
    """Every row, tab-separated under a header; rows come to the driver one partition at a time."""
    print("\t".join(df.columns))
    for r in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in r))


def gallery_as_text(df):
    """Replace ``gallery`` by its text form: ``urls`` ('u1;u2') and ``url_dict`` ('u1##d1;...')."""
    from hearth.functions.codec import encode_keys, encode_pairs
    return (df.withColumn("urls", encode_keys("gallery"))
            .withColumn("url_dict", encode_pairs("gallery")).drop("gallery"))


def import_csv(spark: SparkSession, stage: str, path: str):
    """An earlier run's CSV file as a stage table.

    Legacy column names are mapped, the index column dropped, text galleries
    decoded; ``seq`` keeps the row order, file by file in the order of their names.
    """
    from hearth.functions.codec import decode_pairs
    base = schema.LISTINGS if stage == "listings" else schema.SCREENED
    if stage == "details":
        df = files.read_csv_table(spark, path, schema.DETAILS_TEXT)
        return df.select("house_id", "link", decode_pairs(F.col("url_dict")).alias("gallery"))
    fields = [f for f in base.fields if f.name not in ("seq", "dt")]
    if stage == "final":
        fields = fields + [schema.T.StructField("url_dict", schema.T.StringType())]
    df = files.read_csv_table(spark, path, schema.T.StructType(fields), seq="seq")
    if stage == "final":
        df = df.withColumn("gallery", decode_pairs(F.col("url_dict"))).drop("url_dict")
    return df


if __name__ == "__main__":
    sys.exit(main())
