"""Scanning declared tables and upstream models.

``Catalog`` is the ``source()`` of the package: one Parquet file or folder per
table name.  Reads are lazy, so Catalyst prunes columns and pushes filters
into each scan.  ``materialize`` is the ``table`` materialisation (A25/R5): it
writes a model once to the shared checkpoint folder (partitioned when asked,
so year filters prune whole folders) and reads it back, which cuts the
lineage and survives executor loss.  A ``view`` materialisation is just the
lazy DataFrame.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

MATERIALIZE_CONF = "spark.panelmart.materialize"

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Catalog:
    """Named Parquet tables under one folder, plus memoised derived models."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._models: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        p = f"{self.root}/{name}.parquet"
        return p if os.path.exists(p) or "://" in p else f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        """A1: ``source(schema, table)``."""
        return self.spark.read.parquet(self.path(name))

    __getitem__ = table

    def model(self, name: str, build, materialize: bool | None = None, partition_by: list[str] | None = None,
              bucket_by: list[str] | None = None) -> DataFrame:
        """A2: ``ref(name)``: build once per catalog; optionally write it as a table.

        ``materialize=None`` follows the session setting ``spark.panelmart.materialize``
        (off by default: models stay lazy views).
        """
        if name not in self._models:
            df = build(self)
            if materialize is None:
                materialize = self.spark.conf.get(MATERIALIZE_CONF, "false").lower() == "true"
            if materialize:
                df = materialize_table(self.spark, df, f"{name}-{_digest(self.root)}", partition_by, bucket_by)
            self._models[name] = df
        return self._models[name]


def _digest(text: str) -> str:
    return hashlib.sha1(text.encode()).hexdigest()[:12]


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``), set only when unset."""
    return ensure_checkpoint_dir(spark)


def materialize_table(spark: SparkSession, df: DataFrame, name: str, partition_by: list[str] | None = None,
                      bucket_by: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the re-read table.

    This is the lineage cut used for marts (never ``localCheckpoint``): the files
    live in the shared folder, so losing an executor later costs a re-read, not
    a recomputation of the whole upstream plan.  ``partition_by`` gives folder
    pruning (e.g. one folder per year).  ``bucket_by`` additionally writes the
    table hash-bucketed and sorted on the join keys (registered in the session
    catalog with its path in the shared folder), so later joins and
    aggregations on exactly those keys need no shuffle; the bucket count
    defaults to ``spark.sql.shuffle.partitions``.
    """
    target = f"{shared_dir(spark).rstrip('/')}/panelmart_models/{name}"
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if bucket_by:
        # One task per bucket (same hash as the bucketing), so each task writes
        # one file per bucket and partition instead of one per bucket *per task*.
        df = df.repartition(n, *bucket_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if not bucket_by:
        writer.parquet(target)
        return spark.read.parquet(target)
    table = "panelmart_" + "".join(ch if ch.isalnum() else "_" for ch in name)
    writer.bucketBy(n, *bucket_by).sortBy(*bucket_by).format("parquet").option("path", target).saveAsTable(table)
    return spark.table(table)
