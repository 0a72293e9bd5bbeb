"""Session helpers.

The library never creates a session behind the caller's back; jobs take
the active session.  ``local_session`` exists for tests and the bench,
and ``checkpoint_root`` reads the shared checkpoint folder the cluster
names in ``spark.checkpoint.dir`` (only tests fall back to a scratch dir).
"""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings a job relies on; applied by local_session.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partition values like dt=20250508 stay strings
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # prompts with up to 16 images are wide rows (MBs): cap Arrow batches to the
    # model client by bytes as well as by rows
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
}


def spread(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Deal rows round-robin over ``tasks`` partitions before heavy per-row work.

    A scan yields one task per file split, so a few large files feed only a few
    cores; a caller who knows that asks for more.  Without ``tasks`` the plan is left as
    it is.  Nothing is looked up, so no job runs while the plan is built.
    """
    return df if tasks is None else df.repartition(tasks)


def cluster_conf(executors: int, cores_per_executor: int = 4) -> dict[str, str]:
    """Settings for large runs (e.g. 1000 executors over ~100 TB of pages).

    Shuffles start with ~3 partitions per core and AQE coalesces them to
    ~256 MB each, preferring that size over parallelism; a partition five times
    the median (and over 512 MB) counts as skewed and is split.  Input splits
    stay at 256 MB: pages are large strings, and a split that size keeps a task's
    parsed cards within executor memory.
    """
    cores = executors * cores_per_executor
    return {
        **{k: v for k, v in SESSION_DEFAULTS.items() if k != "spark.ui.enabled"},
        "spark.sql.shuffle.partitions": str(3 * cores),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "hearth", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming state.

    Uses ``spark.checkpoint.dir`` when the cluster sets it; otherwise, in local
    mode only (tests, local runs), a fresh scratch folder.  On a cluster a
    machine-local folder would be lost with its executor, so it is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="hearth-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``hearth`` importable in Python workers (once per application).

    Jobs that run Python on executors (the model call) pickle functions of
    this package by reference, so the workers must import it; the package is
    zipped and added with ``addPyFile`` (``addArtifacts`` under Spark Connect),
    which copies it to every executor.
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # Spark Connect: no SparkContext on the client
        sc, app = None, f"connect-{spark.session_id if hasattr(spark, 'session_id') else id(spark)}"
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="hearth-pkg-"), "hearth.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, names in os.walk(pkg):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(root, n)
                    z.write(full, os.path.relpath(full, base))
    if sc is not None:
        sc.addPyFile(path)
    else:
        spark.addArtifacts(path, pyfile=True)
    _SHIPPED.add(app)
