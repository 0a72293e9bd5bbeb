"""End-to-end jobs over stage tables.

collect   landed list pages -> listings + rejects (+ metrics)
screen    listings -> screened + profiles (frequency tables of what was flagged)
details   landed detail pages of screened listings not yet done -> details (append)
merge     screened x details -> final
cards     final of a day -> its card states (first row and gallery per listing, over all days)
prompts   requests x wishes x final (+ images) -> prompts
replies   prompts not yet answered -> replies (append), via a model client
shortlist replies x final -> qualifying communities and layouts, and the listings themselves

Every job reads its inputs from the stage root and writes its output there,
so each job boundary is a written table (a lineage cut), and re-running a job
for the same day replaces only that day's partition.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.operators import cards, enrich, extract, gallery, metrics, prompt, score, screen
from hearth.schema import FLAG_COLUMNS, WISHES
from hearth.session import checkpoint_root
from hearth.sources import files, regions
from hearth.sources.commits import CommitLog


def _with_dt(df: DataFrame, dt: str) -> DataFrame:
    return df.withColumn("dt", F.lit(dt))


def _cut(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` as a parquet table in the shared checkpoint folder and read it back.

    Used where one computation feeds several writes: it runs once, lineage is
    cut (a lost executor costs no recomputation of the pages behind it), and a
    columnar, compressed table is cheaper to write and re-read than a row
    checkpoint.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path), path


def _drop_cut(spark: SparkSession, path: str) -> None:
    """Remove a ``_cut`` table once its writes are done (best effort)."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        table = jvm.org.apache.hadoop.fs.Path(path)
        table.getFileSystem(conf).delete(table, True)
    except Exception:  # e.g. no JVM access from a Connect client: the folder stays
        pass


def _record(m: DataFrame, root: str, dt: str, run: str | None = None, part: str = "counts") -> str:
    """Append counters to the ``metrics`` stage (computed now, while inputs exist), once per run and part."""
    run = run or files.new_run()
    files.append_stage(_with_dt(m.withColumn("run", F.lit(run)), dt), root, "metrics", f"{run}.{part}")
    return run


def _run_metrics(spark: SparkSession, root: str, dt: str, run: str) -> DataFrame:
    return read_metrics(spark, root, dt).filter(F.col("run") == run)


def read_metrics(spark: SparkSession, root: str, dt: str) -> DataFrame:
    return files.read_stage(spark, root, "metrics", dt=dt)


def collect(spark: SparkSession, pages: DataFrame, root: str, dt: str, city: str = "hd",
            area_name: str = "all", site: extract.Site | None = None,
            debug: bool = False) -> DataFrame:
    """Landed list pages -> ``listings`` and ``rejects`` stages; returns metrics.

    Pages carry their district (its name or its slug), or their URL names it
    (``/<slug>/`` or ``/<slug>/pg<n>/``).  It is looked up in the region
    dimension, a fixed table of a few rows, so it is broadcast.  Pages of
    districts outside the chosen scope, and pages whose district the
    dimension does not know, are left out and counted.  ``debug`` keeps only the first
    page of each district.
    """
    site = site or extract.Site(city=city)
    run = files.new_run()
    given = F.col("district") if "district" in pages.columns else F.lit(None).cast("string")
    pages = pages.withColumn("_named", F.coalesce(given, extract.district_from_url(F.col("url"))))
    every, chosen = regions.districts(spark, city, "all"), regions.districts(spark, city, area_name)
    known = every.unionByName(chosen).select("district_cn", "district_en").distinct()
    dims = (known.join(chosen.select("district_en").distinct().withColumn("_in", F.lit(True)), "district_en", "left")
            .select(F.explode(F.array("district_cn", "district_en")).alias("_named"), F.col("district_cn").alias("_district"),
                    F.coalesce("_in", F.lit(False)).alias("_in")).distinct())
    placed = pages.drop("district").join(F.broadcast(dims), "_named", "left")
    in_scope = F.coalesce("_in", F.lit(False))
    _record(metrics.stage_metrics(placed, "collect", {
        "pages": None, "unrecognised_pages": F.col("_in").isNull(), "out_of_scope_pages": F.col("_in") == F.lit(False)}), root, dt, run, "pages")
    pages = placed.filter(in_scope).withColumnRenamed("_district", "district").drop("_named", "_in")
    if debug:
        pages = pages.filter(F.col("url").rlike(r"/pg1/?$") | ~F.col("url").rlike(r"/pg[0-9]+/?$"))
    parsed = _with_dt(extract.extract_listings(pages, site=site, parsed=True), dt)
    # kept rows do not need their card HTML any more: keep it for rejects only
    parsed, cut = _cut(parsed.withColumn("card", F.when(F.col("reject_reason").isNotNull(),
                                                        F.col("card"))))
    try:
        files.write_stage(extract.kept(parsed), root, "listings", dt)
        files.write_stage(extract.rejected(parsed), root, "rejects", dt)
        _record(metrics.stage_metrics(parsed, "collect", {
            "total_num": None, "err_num": F.col("reject_reason").isNotNull()}), root, dt, run)
    finally:
        _drop_cut(spark, cut)
    return _run_metrics(spark, root, dt, run)


# The screening notebook's frequency tables: profile -> (flag, key column).
SCREEN_PROFILES = {
    "level": (FLAG_COLUMNS[0], "level"),
    "unit_price": (FLAG_COLUMNS[1], "unit_price"),
    "total_price": (FLAG_COLUMNS[2], "total_price"),
}


def screen_stage(spark: SparkSession, root: str, dt: str, top: int = 10) -> DataFrame:
    """listings -> ``screened`` (rows with all three flags 0, flags kept as columns)
    and ``profiles`` (frequencies of the flagged rows: top ``top`` levels, all
    unit and total prices).  Returns the profiles; before/after counts go to
    ``metrics``.
    """
    listings = files.read_stage(spark, root, "listings", dt=dt)
    flagged = screen.add_flags(listings)
    files.write_stage(screen.keep_unflagged(flagged), root, "screened", dt)
    stored = files.read_stage(spark, root, "screened", dt=dt)
    _record(metrics.before_after(listings, stored, "screen"), root, dt)
    prof = screen.profiles(flagged, SCREEN_PROFILES, top={"level": top})
    files.write_stage(prof, root, "profiles", dt)
    return files.read_stage(spark, root, "profiles", dt=dt)


def details_stage(spark: SparkSession, root: str, dt: str, detail_pages: DataFrame,
                  debug_num: int = 0, run: str | None = None) -> DataFrame:
    """Galleries of screened listings that have none yet -> appended to ``details``.

    ``detail_pages(house_id, link, html)`` are the landed detail pages.  Listings
    already in ``details`` are skipped (anti-join), so a second run adds
    nothing; pages without a gallery add no row and are tried again next run.
    ``debug_num`` > 0 handles only the first that many listings.  ``run`` names the
    work: started again under the same name after a failure at any point, it adds
    neither rows nor counters twice.
    """
    run = run or files.new_run()
    screened = files.read_stage(spark, root, "screened", dt=dt)
    done = files.read_stage_if_any(spark, root, "details", dt=dt, without_run=run).select("house_id")
    todo = enrich.pending(screened.select("house_id", "seq"), done)
    if debug_num > 0:
        todo = todo.orderBy("seq").limit(debug_num)
    pages = detail_pages.join(todo.select("house_id"), "house_id", "left_semi")
    # one row per page without its HTML: the gallery (null when the page has
    # no gallery list) and whether the page text is missing
    per_page, cut = _cut(gallery.parse_galleries(pages.withColumn("failed", F.col("html").isNull()),
                                                 keep=("house_id", "link", "failed")))
    try:
        new = per_page.filter(F.col("gallery").isNotNull()).select("house_id", "link", "gallery")
        files.append_stage(_with_dt(new, dt), root, "details", run)
        found = F.col("gallery").isNotNull()
        _record(metrics.stage_metrics(per_page, "details", {
            "pages": None, "found": found, "missing": ~found & ~F.col("failed"),
            "failed": F.col("failed")}), root, dt, run)
    finally:
        _drop_cut(spark, cut)
    return _run_metrics(spark, root, dt, run)


def merge_stage(spark: SparkSession, root: str, dt: str) -> None:
    """screened x details -> ``final`` (inner join, bag semantics).

    A listing that stands twice among the screened and twice among the details
    gives four rows; prompts take a listing's first row and first non-empty gallery.
    """
    screened = files.read_stage(spark, root, "screened", dt=dt)
    details = files.read_stage_if_any(spark, root, "details", dt=dt)
    files.write_stage(enrich.merge_inner(screened.drop("dt"), details, take=("gallery",)), root, "final", dt)
    stored = files.read_stage(spark, root, "final", dt=dt)
    _record(metrics.before_after(screened, stored, "merge"), root, dt)


def cards_log(spark: SparkSession, root: str) -> CommitLog:
    """The day states that listing cards are read from (``operators.cards``), beside the stages."""
    return CommitLog(spark, f"{root.rstrip('/')}/cards", cards.state_schema(files.stage_schema("final")))


def cards_stage(spark: SparkSession, root: str, dt: str, run: str | None = None) -> DataFrame:
    """``final`` of one day -> that day's card states, in place of what it had; gives the cards of all days.

    Only that day is read and written.
    """
    day = files.read_stage(spark, root, "final", dt=dt)
    cards_log(spark, root).replace(cards.day_states(day), run or files.new_run(), dt)
    return current_cards(spark, root)


def current_cards(spark: SparkSession, root: str, requests: DataFrame | None = None) -> DataFrame:
    """``(house_id, info, gallery)`` of every listing of any day (or of those asked for)."""
    return cards.cards(cards_log(spark, root).read(), requests=requests)


def score_all_requests(spark: SparkSession, root: str, dt: str, user_input: str,
                       wish_id: int = 0) -> tuple[DataFrame, DataFrame]:
    """``(requests, wishes)`` that have every listing of ``final`` scored for one buyer's wish."""
    final = files.read_stage(spark, root, "final", dt=dt)
    return (prompt.requests_for_wish(final, wish_id),
            spark.createDataFrame([(wish_id, user_input)], WISHES))


def prompts_stage(spark: SparkSession, root: str, dt: str, requests: DataFrame,
                  wishes: DataFrame, images: DataFrame | None = None, check_images: bool = False) -> None:
    """Render one prompt per request into ``prompts``; requests and repeated wishes are counted.

    ``check_images`` leaves landed images out that are empty, cut off or damaged, and counts them.
    """
    final = files.read_stage(spark, root, "final", dt=dt)
    if images is not None and check_images:
        _record(gallery.image_counts(images), root, dt, part="images")
        images = gallery.sound_images(images)
    files.write_stage(prompt.build_prompts(requests, wishes, final, images), root, "prompts", dt)
    run = _record(metrics.before_after(requests, files.read_stage(spark, root, "prompts", dt=dt), "prompts"), root, dt)
    _record(metrics.stage_metrics(prompt.one_wish_per_id(wishes), "prompts", {
        "wishes": None, "wishes_with_several_texts": F.col("texts") > 1}), root, dt, run, "wishes")


def replies_stage(spark: SparkSession, root: str, dt: str, factory: score.ClientFactory,
                  concurrency: int | None = None, in_flight: int = 4, batch: int = 256,
                  per_minute: float | None = None) -> DataFrame:
    """Ask the model for every prompt without a good reply yet; append to ``replies``.

    Prompts are asked in waves of ``concurrency`` tasks with ``batch`` prompts each, and a wave's
    replies are committed before the next one starts.  A task that fails repeats the calls of
    its open batch, a job that fails those of its open wave, and no more: what
    was committed is never asked again, except failed calls ('' replies), which the
    next run repeats.  ``per_minute`` bounds the calls of all tasks together.  If the
    stored replies can't be read, nothing is asked.  Asked, answered and
    failed calls of the run are counted.
    """
    prompts = files.read_stage(spark, root, "prompts", dt=dt)
    answered = (files.read_stage_if_any(spark, root, "replies", dt=dt)
                .filter(F.col("reply") != "").select("house_id", "wish_id"))
    concurrency = concurrency or spark.sparkContext.defaultParallelism
    run, log = files.new_run(), files.stage_log(spark, root, "replies")
    log.adopt()
    todo, cut = _cut(score.waves(score.unanswered(prompts, answered), concurrency, batch))
    try:
        names = []
        for k in range(todo.agg(F.max("wave")).first()[0] + 1 if not todo.isEmpty() else 0):
            names.append(f"{run}-{k:06d}")
            wave = score.reply_batch(todo.filter(F.col("wave") == k), factory, None, concurrency, in_flight, per_minute)
            log.append(_with_dt(wave, dt), names[-1])
        _record(metrics.stage_metrics(log.read(dt, only=set(names)), "replies", {
            "asked": None, "answered": F.col("outcome") == "answered", "failed": F.col("outcome") != "answered"}), root, dt, run)
    finally:
        _drop_cut(spark, cut)
    return latest_replies(spark, root, dt)


def latest_replies(spark: SparkSession, root: str, dt: str) -> DataFrame:
    """One reply per (house_id, wish_id): a good reply if there is one."""
    r = files.read_stage_if_any(spark, root, "replies", dt=dt)
    return (r.groupBy("house_id", "wish_id")
            .agg(F.max_by("reply", F.col("reply") != "").alias("reply"))
            .withColumn("score", score.parse_score(F.col("reply"))))


def shortlist_stage(spark: SparkSession, root: str, dt: str,
                    min_score: int = score.SHORTLIST_MIN_SCORE):
    """The shortlist for every wish: ``shortlist_groups`` (communities and layouts) and
    ``shortlist`` (the qualifying listings); both are written and returned."""
    replies = latest_replies(spark, root, dt)
    final = files.read_stage(spark, root, "final", dt=dt).drop("gallery", "dt")
    files.write_stage(score.shortlist(replies, final, min_score), root, "shortlist_groups", dt)
    files.write_stage(score.shortlisted_listings(replies, final, min_score), root, "shortlist", dt)
    return (files.read_stage(spark, root, "shortlist_groups", dt=dt),
            files.read_stage(spark, root, "shortlist", dt=dt))
