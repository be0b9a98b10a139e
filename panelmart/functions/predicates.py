"""Row predicates.

All return Columns (or DataFrames for the join-based exclusions) and keep SQL
three-valued logic exactly: a predicate that is NULL drops the row in
``filter``, just as in the reference's WHERE clauses.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import ColumnOrName, col, norm_text


def same_flag(cur: ColumnOrName, prior: ColumnOrName, value=None) -> Column:
    """C17: current flag equals prior flag (and, if given, both equal ``value``)."""
    cond = col(cur) == col(prior)
    if value is not None:
        cond = cond & (col(cur) == F.lit(value))
    return cond


def scenario_ok(source: ColumnOrName, code: ColumnOrName, source_value, exclude_code, null_safe: bool = True) -> Column:
    """Drop rows whose source is ``source_value`` and code is ``exclude_code``.

    ``null_safe=False`` is the plain ``NOT (a AND b)``: a NULL operand makes the
    predicate NULL and ``filter`` drops the row.  ``null_safe=True`` keeps such
    rows (only a definite match is excluded).
    """
    hit = (col(source) == F.lit(source_value)) & (col(code) == F.lit(exclude_code))
    if null_safe:
        return ~F.coalesce(hit, F.lit(False))
    return ~hit


def drop_sentinel(cols: Sequence[ColumnOrName], max_value: float = 1.0) -> Column:
    """Every listed column is NULL or <= max_value."""
    parts = [col(c).isNull() | (col(c) <= F.lit(max_value)) for c in cols]
    return functools.reduce(operator.and_, parts)


def within(x: ColumnOrName, lo: float, hi: float) -> Column:
    """Lo <= x <= hi."""
    return col(x).between(lo, hi)


def outside(x: ColumnOrName, lo: float, hi: float) -> Column:
    """X < lo or x > hi (NULL is neither inside nor outside)."""
    return (col(x) < F.lit(lo)) | (col(x) > F.lit(hi))


def exclude_steps(df: DataFrame, exclusions: DataFrame, step: str, company: str,
                  ex_step: str = "step", ex_company: str = "company") -> DataFrame:
    """C20: drop (step, company) pairs listed in an exclusion table.

    Compared on lower(trim(company)).  The exclusion table is a small seed; it
    is joined as a left-anti join (Spark broadcasts it when its measured size is
    under the broadcast threshold, otherwise a shuffle anti join is used).
    """
    ex = exclusions.select(F.col(ex_step).alias("__ex_step"), norm_text(ex_company).alias("__ex_co")).distinct()
    cond = (F.col(step) == F.col("__ex_step")) & (norm_text(company) == F.col("__ex_co"))
    return df.join(ex, cond, "left_anti")


def exclude(df: DataFrame, key: str, exclusions: DataFrame, ex_key: str | None = None, normalise: bool = True) -> DataFrame:
    """Drop rows whose key is in an exclusion table (a table, never literals)."""
    ex_key = ex_key or key
    left = norm_text(key) if normalise else F.col(key)
    ex = exclusions.select((norm_text(ex_key) if normalise else F.col(ex_key)).alias("__ex_key")).distinct()
    return df.join(ex, left == F.col("__ex_key"), "left_anti")
