"""Window operators.

Every window here is partitioned by a group key, so the rows of one window
partition meet in one task after a single shuffle on that key.  An
unpartitioned window (``OVER ()``) would pull *all* rows into one task; the
shares of a total (F1) therefore join a one-row aggregate instead, and
the few ordered global windows run on already-aggregated rows of bounded
count (steps, years) only.  Orders are explicit about NULL placement
(S2) and carry a tie-break column where the reference has none (S15).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ColumnOrName, col

UNBOUNDED = (Window.unboundedPreceding, Window.unboundedFollowing)


def _w(by: Sequence[str]):
    return Window.partitionBy(*by) if by else Window.partitionBy()


# ---------------------------------------------------------------- F1 / F2
def share(df: DataFrame, x: str, by: Sequence[str] = (), name: str = "share") -> DataFrame:
    """``x / sum(x) OVER (PARTITION BY by)``.

    With no ``by`` (F1) the total is an uncorrelated scalar subquery, so the
    division stays a map-side projection (no single-task window).  With
    ``by`` (F2) the group totals are aggregated and joined back.
    """
    if not by:
        total = df.agg(F.sum(x).alias("__t")).scalar()
        return df.withColumn(name, F.col(x) / F.nullif(total, F.lit(0)))
    totals = df.groupBy(*by).agg(F.sum(x).alias("__t"))
    out = df.join(totals.withColumnsRenamed({k: f"__tk_{k}" for k in by}),
                  [F.col(k).eqNullSafe(F.col(f"__tk_{k}")) for k in by], "inner")
    return out.withColumn(name, F.col(x) / F.nullif(F.col("__t"), F.lit(0))).drop("__t", *[f"__tk_{k}" for k in by])


# ---------------------------------------------------------------- F3 / F4 / F6 / F11
def rank_abs(x: ColumnOrName, by: Sequence[str], tie: Sequence[ColumnOrName] = ()) -> Column:
    """row_number by |x| descending within a group (NULLs last, explicit tie-break)."""
    order = [F.abs(col(x)).desc_nulls_last(), *[col(t).asc_nulls_last() for t in tie]]
    return F.row_number().over(_w(by).orderBy(*order))


def latest(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``QUALIFY row_number() OVER (PARTITION BY by ORDER BY order) = 1``."""
    rn = F.row_number().over(_w(by).orderBy(*order))
    return df.withColumn("__rn", rn).filter(F.col("__rn") == 1).drop("__rn")


def rank_label(x: ColumnOrName, by: Sequence[str], labels: Sequence[str], tie: Sequence[ColumnOrName] = ()) -> Column:
    """rank by value within a group mapped to labels (rank beyond labels -> NULL)."""
    rn = F.row_number().over(_w(by).orderBy(col(x).asc_nulls_last(), *[col(t).asc_nulls_last() for t in tie]))
    out = None
    for i, lab in enumerate(labels, start=1):
        out = F.when(rn == i, F.lit(lab)) if out is None else out.when(rn == i, F.lit(lab))
    return out


# ---------------------------------------------------------------- F5 / F7–F10
def running_sum(x: ColumnOrName, by: Sequence[str], order: ColumnOrName) -> Column:
    """running sum with the default RANGE frame (peers with equal order share)."""
    w = _w(by).orderBy(col(order).asc_nulls_last()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(col(x)).over(w)


def cum_product(rate: ColumnOrName, by: Sequence[str], order: ColumnOrName) -> Column:
    """``exp(sum(ln(1 + r)))`` over ROWS UNBOUNDED PRECEDING; NULL rate counts as 0.

    A rate of -1 makes the product 0 from there on; below -1 there is no index
    (a negative value level has no meaning), so it is NULL from there on.
    """
    w = _w(by).orderBy(col(order).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    factor = F.when(col(rate).isNull(), F.lit(1.0)).otherwise(col(rate) + F.lit(1.0))
    product = F.exp(F.sum(F.when(factor > 0, F.ln(factor))).over(w))
    least = F.min(factor).over(w)
    return F.when(least > 0, product).when(least == 0, F.lit(0.0))


def rebase_first(x: ColumnOrName, by: Sequence[str], order: ColumnOrName) -> Column:
    """F8: ``x / nullif(first_value(x) over full frame, 0) * 100``."""
    w = _w(by).orderBy(col(order).asc_nulls_last()).rowsBetween(*UNBOUNDED)
    return col(x) / F.nullif(F.first(col(x)).over(w), F.lit(0)) * F.lit(100)


def rebase_at(x: ColumnOrName, by: Sequence[str], time: ColumnOrName, at) -> Column:
    """``x / nullif(max(CASE WHEN time = at THEN x END) OVER (PARTITION BY by), 0) * 100``."""
    base = F.max(F.when(col(time) == F.lit(at), col(x))).over(_w(by))
    return col(x) / F.nullif(base, F.lit(0)) * F.lit(100)


def ratio_to_first(x: ColumnOrName, by: Sequence[str], order: ColumnOrName) -> Column:
    """``x / nullif(first_value(x) OVER (PARTITION BY by ORDER BY order), 0)``."""
    w = _w(by).orderBy(col(order).asc_nulls_last())
    return col(x) / F.nullif(F.first(col(x)).over(w), F.lit(0))


# ---------------------------------------------------------------- F12 / F13
def pct_change(x: ColumnOrName, order: ColumnOrName, by: Sequence[str] = ()) -> Column:
    """``x / lag(x) - 1`` over ordered rows (first row NULL)."""
    prev = F.lag(col(x)).over(_w(by).orderBy(col(order).asc_nulls_last()))
    return col(x) / F.nullif(prev, F.lit(0)) - F.lit(1)


def compare_previous(x: ColumnOrName, order: ColumnOrName, by: Sequence[str] = ()) -> Column:
    """previous value in order (for step n vs n−1 checks)."""
    return F.lag(col(x)).over(_w(by).orderBy(col(order).asc_nulls_last()))


def last_by(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """F6 without a window: the row with the largest ``order`` values per group.

    Same result as ``QUALIFY row_number() OVER (PARTITION BY by ORDER BY order
    DESC) = 1`` (ties on every order column resolved by the remaining
    columns), computed as ``max(struct(order…, rest…))``: a partial aggregate,
    so a group holding a third of the rows is reduced map-side instead of
    being sorted in one task.
    """
    rest = [c for c in df.columns if c not in by and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("__best")
    out = df.groupBy(*by).agg(best)
    return out.select(*by, *[F.col(f"__best.{c}").alias(c) for c in [*order, *rest]]).select(*df.columns)
