"""Spark session and shared-folder helpers.

The session settings here are the ones every job in the package relies on:
AQE (runtime partition coalescing and skew-join splitting), UTC timestamps,
ANSI SQL (division by zero raises, so every ratio is guarded), and a shared
checkpoint folder for cutting lineage.  On a cluster the checkpoint folder is
whatever ``spark.checkpoint.dir`` names; only when it is unset (local tests)
do we pick a scratch folder ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings that shape the physical plans; applied to new local sessions and
# documented in the README for cluster submission.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "panelmart",
                  extra_conf: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
    )
    for k, v in {**PLAN_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset."""
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.conf.get("spark.master", "") or ""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share (master {master!r})")
    # Unset in a local test session: a scratch folder is acceptable.
    path = tempfile.mkdtemp(prefix="panelmart-ckpt-", dir=os.environ.get("PANELMART_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def checkpoint(df):
    """Reliable, eager checkpoint into the session's shared checkpoint folder.

    Used to cut the lineage of small, reused intermediate tables; the folder
    is the cluster's ``spark.checkpoint.dir`` (set here only when unset).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
