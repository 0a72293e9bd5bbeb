"""Detail pages landing as files -> galleries appended to ``details``.

The batch ``details`` job, run continuously: a file stream of landed detail
pages; each micro-batch extracts galleries and appends those of listings that
have none yet.  Rows and counters are committed as runs named after the stream and its micro-batch,
so one replayed after a failure adds neither twice.  Progress lives in a
checkpoint under the shared ``spark.checkpoint.dir``.

SURVEY IDs: J2 + S8 run continuously.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hearth.operators import enrich, gallery, metrics
from hearth.session import checkpoint_root
from hearth.sources import files

DETAIL_PAGES_SCHEMA = "house_id bigint, link string, html string"


def _append_new(root: str, dt: str, name: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark, run_name = batch.sparkSession, f"{name}-{dt}-{batch_id}"
        # one slim row per page (gallery or null), used for the rows and the counters
        per_page = gallery.parse_galleries(batch.withColumn("failed", F.col("html").isNull()),
                                           keep=("house_id", "link", "failed")).persist()
        try:
            new = per_page.filter(F.col("gallery").isNotNull()).select("house_id", "link", "gallery")
            done = files.read_stage_if_any(spark, root, "details", dt=dt, without_run=run_name).select("house_id")
            new = enrich.pending(new, done)
            files.append_stage(new.withColumn("dt", F.lit(dt)), root, "details", run_name)
            found = F.col("gallery").isNotNull()
            m = metrics.stage_metrics(per_page, f"landing/{batch_id}", {
                "pages": None, "found": found, "missing": ~found & ~F.col("failed"),
                "failed": F.col("failed")})
            files.append_stage(m.withColumn("run", F.lit(f"landing-{batch_id}"))
                               .withColumn("dt", F.lit(dt)), root, "metrics", run_name)
        finally:
            per_page.unpersist()
    return run


def start_landing(spark: SparkSession, landing_dir: str, root: str, dt: str,
                  available_now: bool = True, name: str = "detail_landing",
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the landing query; ``available_now`` processes what is there and stops."""
    reader = spark.readStream.schema(DETAIL_PAGES_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = reader.parquet(landing_dir)
    ckpt = f"{checkpoint_root(spark)}/streams/{name}/{dt}"
    w = (pages.writeStream.foreachBatch(_append_new(root, dt, name))
         .option("checkpointLocation", ckpt).queryName(name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
