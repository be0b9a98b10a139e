"""Validation funnel, funnel statistics and deviation buckets.

The reference materialises one relation per funnel step and unions one
aggregate per step.  Here the funnel is *one* annotated frame: every row
carries ``funnel_stage`` = the number of steps it passed.  Each step is a
group-level test computed on the rows still alive (one partial aggregate +
one join back), so the whole funnel is a linear plan; the per-step
statistics are then one generator (a row alive at stage s counts for steps
0..s) and one aggregate, instead of N recomputations of growing prefixes.

Group tables have one row per group (company, complex); each is written to
the shared checkpoint folder (which also keeps the plan linear in the number
of steps) and broadcast back behind a row-count proof, so a hot company (a
third of all rows) never meets a single-task window or a skewed shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint

from ..functions.columns import bucket, count_flags, fround
from ..operators.aggregates import count_distinct_concat
from ..operators.joins import small_dim

STAGE = "funnel_stage"


@dataclass
class GroupMean:
    """Keep groups whose mean of ``col`` is strictly above ``threshold``."""
    label: str
    keys: Sequence[str]
    col: str
    threshold: float


@dataclass
class ExcludeGroups:
    """Drop whole groups that have any alive row matching ``pred``."""
    label: str
    keys: Sequence[str]
    pred: Column


@dataclass
class RowFilter:
    """Keep rows where ``pred`` is TRUE (NULL drops the row, as in SQL)."""
    label: str
    pred: Column


@dataclass
class GroupCount:
    """Keep groups with strictly more than ``min_rows`` alive rows."""
    label: str
    keys: Sequence[str]
    min_rows: int


def _group_table(df: DataFrame, max_groups: int) -> DataFrame:
    """Materialise a per-group step table (small: one row per group) in the shared
    checkpoint folder and broadcast it when its row count is proven bounded.

    Writing it cuts the lineage: step i's table is a leaf of step i+1's plan,
    so the funnel plan grows linearly with the number of steps (each step
    reads the rows once more) instead of doubling with every step.
    """
    return small_dim(checkpoint(df), max_groups)


def validation_funnel(df: DataFrame, steps: Sequence, max_groups: int = 1_000_000) -> DataFrame:
    """Annotate each row with the number of funnel steps it passes."""
    cur = df.withColumn(STAGE, F.lit(0))
    for i, step in enumerate(steps, start=1):
        alive = F.col(STAGE) == F.lit(i - 1)
        if isinstance(step, RowFilter):
            passed = F.coalesce(step.pred, F.lit(False))
            cur = cur.withColumn(STAGE, F.when(alive & passed, F.lit(i)).otherwise(F.col(STAGE)))
            continue
        keys = list(step.keys)
        src = cur.filter(alive)
        if isinstance(step, GroupMean):
            good = src.groupBy(*keys).agg(F.avg(step.col).alias("__v")).filter(F.col("__v") > F.lit(step.threshold))
        elif isinstance(step, GroupCount):
            good = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("__v")).filter(F.col("__v") > F.lit(step.min_rows))
        elif isinstance(step, ExcludeGroups):
            # Anti-join semantics: a row passes unless its group is listed as bad
            # (a NULL key never matches, so such rows pass, as in SQL).
            bad = _group_table(src.filter(step.pred).select(*keys).distinct().withColumn("__bad", F.lit(True)), max_groups)
            cur = cur.join(bad, keys, "left")
            cur = cur.withColumn(STAGE, F.when(alive & F.col("__bad").isNull(), F.lit(i)).otherwise(F.col(STAGE))).drop("__bad")
            continue
        else:
            raise TypeError(step)
        good = _group_table(good.select(*keys).withColumn("__ok", F.lit(True)), max_groups)
        cur = cur.join(good, keys, "left")
        cur = cur.withColumn(STAGE, F.when(alive & F.col("__ok").isNotNull(), F.lit(i)).otherwise(F.col(STAGE))).drop("__ok")
    return cur


def funnel_result(annotated: DataFrame, n_steps: int) -> DataFrame:
    """Rows that passed every step (the validation dataset)."""
    return annotated.filter(F.col(STAGE) == n_steps).drop(STAGE)


def funnel_stats(annotated: DataFrame, labels: Sequence[str], company: str, sub: str, complex_: str,
                 value: str, scale: float = 1e9, digits: int = 1) -> DataFrame:
    """Per step, distinct companies, sub-companies, complexes, rows and value (in ``scale``).

    A row alive at stage s is counted for steps 0..s (``sequence`` +
    ``explode``: at most len(labels) copies per row), then one aggregate; the
    step list (a ``range``) is left-joined so empty steps still report.
    """
    names = F.array(*[F.lit(x) for x in labels])
    exploded = annotated.select(
        company, sub, complex_, value, F.explode(F.sequence(F.lit(0), F.col(STAGE))).alias("step_no"))
    agg = exploded.groupBy("step_no").agg(
        F.count_distinct(F.col(company)).alias("n_companies"),
        count_distinct_concat([company, sub]).alias("n_sub_companies"),
        count_distinct_concat([company, sub, complex_]).alias("n_complexes"),
        F.count(F.lit(1)).alias("n_units"),
        fround(F.sum(value) / F.lit(scale), digits).alias("value_bn"),
    )
    # Every step has a row, also when no row survives it (counts 0, value NULL),
    # like an aggregate without GROUP BY over an empty step relation.
    steps = annotated.sparkSession.range(len(labels)).select(F.col("id").cast("int").alias("step_no"))
    full = steps.join(agg, ["step_no"], "left").fillna(0, ["n_companies", "n_sub_companies", "n_complexes", "n_units"])
    return full.select(names[F.col("step_no")].alias("step"), "step_no", "n_companies", "n_sub_companies",
                       "n_complexes", "n_units", "value_bn")


# ---------------------------------------------------------------- I8
def deviation_buckets(dev: DataFrame, value: str, weight: str, edges: Sequence[float], labels: Sequence[str],
                      domain: DataFrame) -> DataFrame:
    """I8: bucket per-group deviations, complete to the full bucket list, shares.

    ``dev`` has one row per group with the deviation ``value`` and a unit
    count ``weight``.  ``domain`` is the bucket list (label, order).  Shares
    are over all groups / all units (scalar subqueries, no global window).
    """
    b = dev.select(bucket(value, edges, labels).alias("bucket"), F.col(weight).alias("__w"))
    agg = b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_groups"), F.sum("__w").alias("n_units"))
    full = domain.join(agg, ["bucket"], "left").fillna({"n_groups": 0, "n_units": 0})
    tg = dev.agg(F.count(F.lit(1))).scalar()
    tu = dev.agg(F.sum(weight)).scalar()
    return full.select("*", (F.col("n_groups") / F.nullif(tg, F.lit(0))).alias("share_groups"),
                       (F.col("n_units") / F.nullif(tu, F.lit(0))).alias("share_units"))


# ---------------------------------------------------------------- I1
def override_class(df: DataFrame, full_cols: Sequence[str], free_cols: Sequence[str], hits: Sequence,
                   labels: tuple[str, str, str] = ("free", "full", "basis")) -> DataFrame:
    """Count hits in two column lists; binary flags; class with precedence free > full > basis."""
    n_full = count_flags(full_cols, hits)
    n_free = count_flags(free_cols, hits)
    return df.select(
        "*",
        n_full.alias("n_full_hits"), n_free.alias("n_free_hits"),
        F.when(n_full > 0, F.lit(1)).otherwise(F.lit(0)).alias("pct_full_flag"),
        F.when(n_free > 0, F.lit(1)).otherwise(F.lit(0)).alias("free_flag"),
        F.when(n_free > 0, F.lit(labels[0])).when(n_full > 0, F.lit(labels[1])).otherwise(F.lit(labels[2]))
        .alias("override_class"),
    )
