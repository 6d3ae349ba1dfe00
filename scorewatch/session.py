"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings every job relies on.

    * Session zone UTC: timestamps in the lake are UTC wall clock
      (``timestamp_ntz``); ISO strings with offsets are normalised to UTC.
    * ANSI stays on (Spark 4 default) so decimal overflow raises, as the
      warehouse would.
    * AQE stays on: it coalesces shuffle partitions, splits skewed join
      partitions and turns a sort-merge join into a broadcast only after it
      has measured the smaller side at runtime.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; it is
    read from the session. Only a local-mode session without one (tests,
    benchmark) gets a private folder under the system temp dir.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver context; the server's setting applies
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/object store) before running jobs that cut lineage")
    path = tempfile.mkdtemp(prefix="scorewatch-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "scorewatch") -> SparkSession:
    """A local session for tests and the benchmark (UI off, no ports beyond
    Spark's own)."""
    parts = shuffle_partitions or (os.cpu_count() or 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
