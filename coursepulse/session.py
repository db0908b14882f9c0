"""Session and lineage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "coursepulse") -> SparkSession:
    """Create (or return) a session with the settings the operators assume.

    AQE re-plans joins and coalesces/splits skewed shuffle partitions at run time; the
    session time zone is pinned so day arithmetic is stable across machines.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    # AQE merges small shuffle partitions but never makes more: the number is the cluster's unless given
    parts = shuffle_partitions or os.environ.get("COURSEPULSE_SHUFFLE_PARTITIONS")
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(int(parts)))
    spark = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir``. Where it is not set, a local session (tests) gets
    a scratch folder; on a cluster that is an error, as executors do not share a machine's folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="coursepulse-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
