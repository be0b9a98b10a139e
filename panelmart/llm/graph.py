"""Connected components of an edge table, as Spark joins and aggregates.

Alternating large-star and small-star rounds: each round is one aggregate and
one join per star, its edges are written to the shared folder (lineage cut),
and the loop ends when a round changes nothing.  Nothing but two numbers per
round (row count, hash sum) comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmart.llm.common import scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component: its smallest node.

    An empty edge table gives an empty result.
    """
    current = scratch(_small_star(edges).distinct(), "components")
    state = _state(current)
    while state[0]:
        after = scratch(_small_star(_large_star(current).distinct()).distinct(), "components")
        new = _state(after)
        current, done, state = after, new == state, new
        if done:
            break
    out = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return out.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
