"""Sorts, top-k, unions and precedence.

Sorting for presentation (H2) is left to the exporter: results are sets and
the driver compares them order-free.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ColumnOrName, col, order_by_map
from .windows import rank_abs


def sort_by_map(df: DataFrame, c: str, order: Sequence[str], *then: Column) -> DataFrame:
    """H1: sort by business order; unknown values (NULL rank) last."""
    return df.orderBy(order_by_map(c, order).asc_nulls_last(), *then)


def top_n_union(df: DataFrame, by: Sequence[str], item: str, score: ColumnOrName, n: int) -> DataFrame:
    """H3: top-n items by |score| per group, union of the groups' sets, re-ranked by mean |score|.

    Returns (item, item_order).  The per-group ranking is a window partitioned
    by the group; the union is a distinct over at most n × groups items; the
    re-rank is an ordered window over that bounded item set (ties broken by
    the item name, S15).
    """
    ranked = df.withColumn("__rn", rank_abs(score, by, tie=[item]))
    selected = ranked.filter(F.col("__rn") <= n).select(item).distinct()
    means = df.join(selected, [item], "left_semi").groupBy(item).agg(F.avg(F.abs(col(score))).alias("__m"))
    order = F.row_number().over(Window.orderBy(F.col("__m").desc_nulls_last(), F.col(item).asc()))
    return means.withColumn("item_order", order).drop("__m")


def stack(dfs: Sequence[DataFrame], by_name: bool = True, fill: bool = True) -> DataFrame:
    """H4: UNION ALL by position, or BY NAME with missing columns as NULL."""
    if by_name:
        return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), dfs)
    return functools.reduce(lambda a, b: a.union(b), dfs)


def distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """H5: SELECT DISTINCT cols."""
    return df.select(*cols).distinct()


def with_history(cur: DataFrame, history: DataFrame) -> DataFrame:
    """H6: current rows plus rows from a history *table* (never literals)."""
    return cur.unionByName(history, allowMissingColumns=True)


def prefer_current(cur: DataFrame, history: DataFrame, keys: Sequence[str], time: str, cur_time) -> DataFrame:
    """H7: history up to and with the current year, only for keys absent from the current source."""
    hist = history.filter(F.col(time) <= F.lit(cur_time))
    hist = hist.join(cur.select(*keys).distinct(), list(keys), "left_anti")
    return cur.unionByName(hist, allowMissingColumns=True)
