"""Sinks.

* A24: partition-scoped replace — dynamic partition overwrite rewrites only
  the partitions present in the new data (one company's rows); partition
  values are escaped by Spark, so names with quotes are safe.  Where the load
  names its partitions, one that it has no rows for loses its old rows.
* A25: ``materialize_table`` (in ``tables``) for table models; views are
  lazy DataFrames / temp views.
* A26: load statistics with ``DataFrame.observe`` — counted while the data is
  written, no extra pass.
* A27: detail + summary pair written side by side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet",
                       requested: Sequence[Sequence] | None = None) -> None:
    """Overwrite only the partitions present in ``df``.

    ``requested`` lists the partitions (values in the order of ``partition_by``) that the
    load stands for: a row of another partition fails the load before anything is written,
    and a requested partition without rows is emptied.  The new rows are in place before
    the empty partitions go, so a lost executor never leaves less than was loaded.
    """
    spark = df.sparkSession
    empty = None
    if requested is not None:
        kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in partition_by)
        wanted = spark.createDataFrame([tuple(v) for v in requested], kinds).distinct()
        same = lambda a, b: reduce(and_, (F.col(f"{a}.`{c}`").eqNullSafe(F.col(f"{b}.`{c}`")) for c in partition_by))
        present = df.select(*[F.col(f"`{c}`") for c in partition_by]).distinct()
        other = present.alias("p").join(wanted.alias("w"), same("p", "w"), "left_anti").first()
        if other is not None:
            raise ValueError(f"rows of a partition that was not requested: {other.asDict()}")
        # at most as many rows as were requested
        left = wanted.alias("w").join(present.alias("p"), same("w", "p"), "left_anti")
        empty = left.select(*[F.col(f"`{c}`").cast("string") for c in partition_by]).collect()
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).format(fmt).save(path))
    if empty:
        jvm = spark._jvm
        name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        for values in empty:
            folder = jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *(name(c, v) for c, v in zip(partition_by, values))]))
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """A25 view materialisation: a temp view over the lazy plan."""
    df.createOrReplaceTempView(name)
    return df


def write_with_stats(df: DataFrame, path: str, key: str | None = None, fmt: str = "parquet",
                     partition_by: Sequence[str] = ()) -> dict:
    """Write and return row / column / distinct-key counts observed during the write.

    Distinct keys use ``approx_count_distinct`` (an observed metric must be a
    mergeable aggregate); rows are exact.
    """
    obs = Observation("load_stats")
    metrics = [F.count(F.lit(1)).alias("rows")]
    if key:
        metrics.append(F.approx_count_distinct(key).alias("distinct_keys"))
    w = df.observe(obs, *metrics).write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    out = dict(obs.get)
    out["columns"] = len(df.columns)
    return out


def load_stats(df: DataFrame, key: str | None = None) -> DataFrame:
    """A26 as a query: one row with row count, column count and distinct keys."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")]
    if key:
        aggs.append(F.count_distinct(key).alias("n_keys"))
    return df.agg(*aggs)


def export_pair(detail: DataFrame, summary: DataFrame, path: str, fmt: str = "parquet") -> tuple[str, str]:
    """Write a detail table and its summary next to each other."""
    d, s = f"{path.rstrip('/')}/detail", f"{path.rstrip('/')}/summary"
    detail.write.mode("overwrite").format(fmt).option("header", True).save(d)
    summary.write.mode("overwrite").format(fmt).option("header", True).save(s)
    return d, s
