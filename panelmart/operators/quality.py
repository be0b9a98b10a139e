"""Data-quality operators.

Each check returns the *violating rows* (pass = empty), like the reference's
singular SQL tests.  ``run_report`` turns a list of checks into one lazy
DataFrame (name, severity, violations, status): each check is reduced to a
single count row by a partial aggregate and the rows are unioned, so the
whole suite is one Spark job and no check result passes through the driver.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import rel_change
from ..operators.windows import compare_previous


# ---------------------------------------------------------------- K1–K3
def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """K1: rows where any of ``cols`` is NULL."""
    return df.filter(functools.reduce(operator.or_, [F.col(c).isNull() for c in cols]))


def unique(df: DataFrame, keys: Sequence[str], count_name: str = "n") -> DataFrame:
    """K2: key values that occur more than once (also the join-fanout guard)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)


def unique_not_null(df: DataFrame, key: str) -> DataFrame:
    """K3: duplicated key values, plus one row with the NULL-key count when it is > 0."""
    dupes = unique(df, [key]).select(F.col(key).cast("string").alias("key_value"), "n", F.lit("duplicate").alias("issue"))
    nulls = df.agg(F.count(F.when(F.col(key).isNull(), F.lit(1))).alias("n")).filter(F.col("n") > 0).select(
        F.lit(None).cast("string").alias("key_value"), "n", F.lit("null").alias("issue"))
    return dupes.unionByName(nulls)


# ---------------------------------------------------------------- K4–K9
def accepted_values(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    """K4/K5: rows whose value is not in the accepted list (NULL passes)."""
    return df.filter(~F.col(c).isin(list(values)))


def binary_flag(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """K5: rows where any flag column is not 0/1 (NULL passes)."""
    return df.filter(functools.reduce(operator.or_, [~F.coalesce(F.col(c).isin(0, 1), F.lit(True)) for c in cols]))


def in_range(df: DataFrame, c: str, lo: float | None, hi: float | None) -> DataFrame:
    """K6: rows outside [lo, hi] (either bound optional; NULL passes)."""
    conds = []
    if lo is not None:
        conds.append(F.col(c) < F.lit(lo))
    if hi is not None:
        conds.append(F.col(c) > F.lit(hi))
    return df.filter(functools.reduce(operator.or_, conds))


def rule(df: DataFrame, pred: Column) -> DataFrame:
    """K7: rows violating a row rule (the rule evaluates to FALSE; NULL passes)."""
    return df.filter(~pred)


def components_sum(df: DataFrame, total: str, parts: Sequence[tuple[str, int]], tol: float) -> DataFrame:
    """K8: rows where |total − Σ sign·part| > tol (NULL parts count as 0)."""
    s = functools.reduce(operator.add, [F.lit(sign) * F.coalesce(F.col(c), F.lit(0.0)) for c, sign in parts])
    return df.filter(F.abs(F.col(total) - s) > F.lit(tol))


def implies(df: DataFrame, a: Column, b: Column, both: bool = True) -> DataFrame:
    """K9: rows with a ∧ ¬b (and, if ``both``, b ∧ ¬a)."""
    bad = a & ~b
    if both:
        bad = bad | (b & ~a)
    return df.filter(bad)


# ---------------------------------------------------------------- K10 / K11
def foreign_key(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (left anti join)."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return child.filter(F.col(child_key).isNotNull()).join(p, F.col(child_key) == F.col("__pk"), "left_anti")


def subset_of(sub: DataFrame, sup: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``sub`` absent from ``sup``."""
    return sub.join(sup.select(*on).distinct(), list(on), "left_anti")


def attribute_check(sub: DataFrame, sup: DataFrame, on: Sequence[str], pred: Column) -> DataFrame:
    """Join back to the superset and keep rows whose attribute fails ``pred``."""
    return sub.select(*on).join(sup, list(on), "left").filter(~F.coalesce(pred, F.lit(False)))


# ---------------------------------------------------------------- K12–K15
def monotonic(df: DataFrame, order: str, value: str, increasing: bool = False) -> DataFrame:
    """Rows where the value moves the wrong way relative to the previous row in order."""
    prev = compare_previous(value, order)
    out = df.withColumn("previous_value", prev)
    bad = F.col(value) < F.col("previous_value") if increasing else F.col(value) > F.col("previous_value")
    return out.filter(bad)


def yoy_bounds(df: DataFrame, cur: str, prev: str, lo: float, hi: float) -> DataFrame:
    """Rows whose relative YoY change is outside [lo, hi]."""
    r = rel_change(cur, prev)
    return df.withColumn("yoy_change", r).filter((F.col("yoy_change") < lo) | (F.col("yoy_change") > hi))


def chain_complete(df: DataFrame, trigger: str, cols: Sequence[str]) -> DataFrame:
    """Rows where the trigger is set but a column of the mapping chain is NULL."""
    missing = functools.reduce(operator.or_, [F.col(c).isNull() for c in cols])
    return df.filter(F.col(trigger).isNotNull() & missing)


def mixed_checks(df: DataFrame, not_null_cols: Sequence[str], unique_key: str) -> DataFrame:
    """NULL and duplicate violations in one labelled result."""
    nn = [df.filter(F.col(c).isNull()).select(F.lit(f"{c} is null").alias("issue"), F.col(unique_key).cast("string").alias("key_value"))
          for c in not_null_cols]
    du = unique(df, [unique_key]).select(F.lit(f"{unique_key} not unique").alias("issue"), F.col(unique_key).cast("string").alias("key_value"))
    return functools.reduce(lambda a, b: a.unionByName(b), [*nn, du])


# ---------------------------------------------------------------- K16
@dataclass
class Check:
    name: str
    rows: DataFrame
    severity: str = "error"     # 'error' or 'warn'
    warn_if: int = 1            # violations >= warn_if make a warn-severity check WARN
    error_if: int = 1           # violations >= error_if make an error-severity check FAIL


@dataclass
class RowCheck:
    """A row-level check on ``table``: a row violates it when ``violation`` is TRUE (NULL passes)."""
    name: str
    table: DataFrame
    violation: Column
    severity: str = "error"
    warn_if: int = 1
    error_if: int = 1


def _status(name: str, severity: str, limit: int, violations: Column) -> list[Column]:
    bad = "fail" if severity == "error" else "warn"
    return [F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), violations.alias("violations"),
            F.when(violations >= F.lit(limit), F.lit(bad)).otherwise(F.lit("pass")).alias("status")]


def run_report(checks: Sequence[Check | RowCheck]) -> DataFrame:
    """One row per check: name, severity, violations, status (pass / warn / fail).

    A :class:`Check` is counted by its own partial aggregate.  All
    :class:`RowCheck` s on the same table share **one** scan: one aggregate of
    ``count(CASE WHEN violation …)`` per check, then a generator emits one row
    per check (so five row rules on the fact read the fact once).
    """
    parts = []
    by_table: dict[int, list[RowCheck]] = {}
    for chk in checks:
        if isinstance(chk, RowCheck):
            by_table.setdefault(id(chk.table), []).append(chk)
            continue
        limit = chk.error_if if chk.severity == "error" else chk.warn_if
        n = chk.rows.agg(F.count(F.lit(1)).alias("violations"))
        parts.append(n.select(*_status(chk.name, chk.severity, limit, F.col("violations"))))
    for group in by_table.values():
        counts = group[0].table.agg(*[F.count(F.when(c.violation, F.lit(1))).alias(f"__v{i}") for i, c in enumerate(group)])
        rows = [F.struct(*_status(c.name, c.severity, c.error_if if c.severity == "error" else c.warn_if,
                                  F.col(f"__v{i}"))) for i, c in enumerate(group)]
        parts.append(counts.select(F.inline(F.array(*rows))))
    return functools.reduce(lambda a, b: a.unionByName(b), parts)

