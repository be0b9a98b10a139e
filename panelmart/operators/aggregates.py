"""Aggregations.

All aggregates are ``groupBy``/``groupingSets`` plans: Spark runs a partial
aggregate before the shuffle, so only one row per group and partition crosses
the network.  Totals are produced with GROUPING SETS (one scan, an Expand
node) instead of a UNION of aggregates (R9).  Exact medians and percentiles
go through ``percentiles.percentile_table``: a bounded-memory, skew-safe plan
that never buffers a whole group in one task (R16), with the same exact
interpolated result as ``F.median``.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint

from ..functions.columns import ColumnOrName, col, fround
from .joins import small_dim
from .percentiles import Pct, _null_safe_join, percentile_table, use_builtin
from .percentiles import median as median_of  # noqa: F401  (re-exported)
from .percentiles import percentile as percentile_of  # noqa: F401

TOTAL = "Total"


@dataclass
class Derived:
    """An output computed from other aggregates (e.g. a difference of medians)."""
    parts: list
    post: Column
    hidden: list[str] = field(default_factory=list)


def _split(aggs) -> tuple[list[Column], list[Pct], list[Column], list[str]]:
    regular, pcts, posts, hidden = [], [], [], []

    def add(a):
        if isinstance(a, Pct):
            pcts.append(a)
        elif isinstance(a, Derived):
            for part in a.parts:
                add(part)
            posts.append(a.post)
            hidden.extend(a.hidden)
        else:
            regular.append(a)

    for a in aggs:
        add(a)
    return regular, pcts, posts, hidden


def _dims_of(sets: Sequence[Sequence[str]]) -> list[str]:
    dims: list[str] = []
    for s in sets:
        for d in s:
            if d not in dims:
                dims.append(d)
    return dims


def aggregate(df: DataFrame, by: Sequence[str] = (), aggs: Sequence = (), sets: Sequence[Sequence[str]] | None = None,
              labels: Mapping[str, str] | None = None, keep_levels: bool = False) -> DataFrame:
    """GROUP BY (or GROUPING SETS) with ordinary aggregates, exact percentiles and derived outputs.

    Ordinary aggregates run in one ``groupBy``/``groupingSets`` (partial
    aggregation).  Percentiles (:class:`Pct`) run through the bounded
    bracket plan of ``percentiles.percentile_table`` and are joined back on
    the group keys; an input proven to hold fewer rows than the sketch
    accuracy uses ``F.percentile`` directly (``percentiles.use_builtin``).  ``sets`` rolls dimensions up (GROUPING SETS); rolled-up
    dimensions get a label (default 'Total'), real NULL groups stay NULL.
    """
    regular, pcts, posts, hidden = _split(aggs)
    if pcts and use_builtin(df):
        regular += [p.builtin() for p in pcts]
        pcts = []
    carrier = [] if regular else [F.count(F.lit(1)).alias("__cnt")]
    if sets is None:
        by = list(by)
        keys = by or ["__all"]
        src = df if by else df.withColumn("__all", F.lit(0))
        g = src.groupBy(*keys).agg(*regular, *carrier)
        if pcts:
            pt = percentile_table(src, keys, pcts)
            g = _join_keys(g, pt, keys)
        out = g.drop("__all", "__cnt")
    else:
        dims = _dims_of(sets)
        n = len(dims)
        g = df.groupingSets([list(s) for s in sets], *dims).agg(
            *regular, *carrier, F.grouping_id(*dims).alias("__gid"))
        if pcts:
            types = dict(df.dtypes)
            structs = []
            for s in sets:
                gid = sum(1 << (n - 1 - i) for i, d in enumerate(dims) if d not in s)
                structs.append(F.struct(F.lit(gid).cast("long").alias("__gid"), *[
                    (F.col(d) if d in s else F.lit(None).cast(types[d])).alias(f"__k_{d}") for d in dims]))
            exp = df.select("*", F.inline(F.array(*structs)))
            kcols = ["__gid", *[f"__k_{d}" for d in dims]]
            pt = percentile_table(exp, kcols, pcts).withColumnsRenamed({f"__k_{d}": d for d in dims})
            g = _join_keys(g, pt, ["__gid", *dims])
        labels = dict(labels or {}) or {d: TOTAL for d in dims}
        out_dims = []
        for i, d in enumerate(dims):
            if d in labels:
                rolled = F.shiftright(F.col("__gid"), n - 1 - i).bitwiseAND(F.lit(1)) == 1
                out_dims.append(F.when(rolled, F.lit(labels[d])).otherwise(F.col(d).cast("string")).alias(d))
            else:
                out_dims.append(F.col(d))
        rest = [c for c in g.columns if c not in dims and c not in ("__gid", "__cnt")]
        extra = [F.col("__gid").alias("grouping_id")] if keep_levels else []
        out = g.select(*out_dims, *[F.col(c) for c in rest], *extra)
    if posts:
        out = out.select("*", *posts)
    return out.drop(*hidden) if hidden else out


def _join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two per-group tables on ``keys``, NULL-safe (rolled-up / NULL groups)."""
    r = right.withColumnsRenamed({k: f"__pk_{k}" for k in keys})
    cond = [F.col(k).eqNullSafe(F.col(f"__pk_{k}")) for k in keys]
    return left.join(r, cond, "left").drop(*[f"__pk_{k}" for k in keys])


# ---------------------------------------------------------------- E1 / E2
def summarise(df: DataFrame, by: Sequence[str], aggs: Sequence) -> DataFrame:
    """Avg / sum / count / max by 1–4 keys (percentiles allowed)."""
    return aggregate(df, by, aggs)


def medians(df: DataFrame, by: Sequence[str], cols: Sequence[str], suffix: str = "_median",
            count_name: str | None = "n") -> DataFrame:
    """Exact (interpolating) median of several measures by group (bounded-memory plan)."""
    aggs: list = [median_of(c, c + suffix) for c in cols]
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    return aggregate(df, by, aggs)


# ---------------------------------------------------------------- E3 / E4
def median_change(cur: ColumnOrName, prev: ColumnOrName, how: str, name: str) -> Pct | Derived:
    """``median(cur) - median(prev)`` or ``median(cur - prev)`` (both occur)."""
    if how == "difference_of_medians":
        a, b = f"__{name}_c", f"__{name}_p"
        return Derived([median_of(cur, a), median_of(prev, b)], (F.col(a) - F.col(b)).alias(name), [a, b])
    if how == "median_of_differences":
        return median_of(col(cur) - col(prev), name)
    raise ValueError(how)


def ratio(num: ColumnOrName, den: ColumnOrName, how: str, name: str) -> Pct | Derived:
    """Ratio of medians, median of ratios, or ratio of means (all guarded)."""
    if how == "ratio_of_medians":
        a, b = f"__{name}_n", f"__{name}_d"
        return Derived([median_of(num, a), median_of(den, b)], (F.col(a) / F.nullif(F.col(b), F.lit(0))).alias(name), [a, b])
    if how == "median_of_ratios":
        return median_of(col(num) / F.nullif(col(den), F.lit(0)), name)
    if how == "ratio_of_means":
        return (F.avg(col(num)) / F.nullif(F.avg(col(den)), F.lit(0))).alias(name)
    raise ValueError(how)


# ---------------------------------------------------------------- E5–E8 / I9
def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], aggs: Sequence,
                  labels: Mapping[str, str] | None = None, keep_levels: bool = False) -> DataFrame:
    """Native GROUPING SETS; rolled-up dimensions get a label (default 'Total').

    ``labels`` maps a dimension to its total label.  A real NULL group value
    stays NULL (the grouping id tells the two apart).  With ``keep_levels`` a
    ``grouping_id`` column is kept.  ``aggs`` may hold exact percentiles.
    """
    return aggregate(df, aggs=aggs, sets=sets, labels=labels, keep_levels=keep_levels)


def with_totals(df: DataFrame, by: Sequence[str], total_dims: Sequence[str], aggs: Sequence[Column],
                national: bool = False, total_label: str = TOTAL) -> DataFrame:
    """Segment rows plus total rows, in one scan.

    ``by`` are the kept group keys; every subset of ``total_dims`` is rolled
    up (1 dim: detail + total, E5; 2 dims: the 2×2 cube, E6).  ``national``
    adds the grand total ``()`` over everything including ``by`` (E7).
    """
    by, total_dims = list(by), list(total_dims)
    sets: list[list[str]] = []
    n = len(total_dims)
    for mask in range(2**n):
        kept = [d for i, d in enumerate(total_dims) if not (mask >> i) & 1]
        sets.append(by + kept)
    if national:
        sets.append([])
    labels = {d: total_label for d in total_dims + (by if national else [])}
    return grouping_sets(df, sets, aggs, labels)


# ---------------------------------------------------------------- E9–E11
def count_where(pred: Column) -> Column:
    """``count(*) FILTER (WHERE pred)``."""
    return F.count(F.when(pred, F.lit(1)))


def avg_where(x: ColumnOrName, pred: Column) -> Column:
    """``avg(x) FILTER (WHERE pred)``."""
    return F.avg(F.when(pred, col(x)))


def pivot_avg(x: ColumnOrName, on: ColumnOrName, values: Sequence, names: Sequence[str] | None = None) -> list[Column]:
    """Conditional pivot, one ``avg(CASE WHEN on = v THEN x END)`` per value."""
    names = names or [str(v) for v in values]
    return [F.avg(F.when(col(on) == F.lit(v), col(x))).alias(n) for v, n in zip(values, names)]


def count_distinct_concat(cols: Sequence[ColumnOrName]) -> Column:
    """``COUNT(DISTINCT a || b || c)``; a NULL part drops the row (concat is NULL-strict)."""
    return F.count_distinct(F.concat(*[col(c).cast("string") for c in cols]))


# ---------------------------------------------------------------- E12–E16
def having(agg: DataFrame, pred: Column) -> DataFrame:
    """HAVING is a filter after the aggregate."""
    return agg.filter(pred)


def summarise_by_label(df: DataFrame, label: Column, name: str, by: Sequence[str], aggs: Sequence[Column],
                       drop_null_label: bool = True) -> DataFrame:
    """Group by a computed label (e.g. a step map), optionally HAVING label IS NOT NULL."""
    out = df.withColumn(name, label).groupBy(*by, name).agg(*aggs)
    return out.filter(F.col(name).isNotNull()) if drop_null_label else out


def classify_group(df: DataFrame, by: Sequence[str], cond_sum: Column, name: str, if_zero: str, otherwise: str) -> DataFrame:
    """Class per group from ``sum(CASE …) = 0``."""
    return df.groupBy(*by).agg(F.when(F.sum(cond_sum) == 0, F.lit(if_zero)).otherwise(F.lit(otherwise)).alias(name))


def share_where(pred: Column) -> Column:
    """``count(*) FILTER (WHERE pred) / nullif(count(*), 0)``."""
    return count_where(pred) / F.nullif(F.count(F.lit(1)), F.lit(0))


def growth_gap(df: DataFrame, time: str, cur, prev, value: str, kind: str, a: str, b: str, digits: int = 3) -> DataFrame:
    """One global row: growth of kind ``a`` minus growth of kind ``b`` between two years.

    The gap is rounded half up to ``digits`` decimals (the reference rounds it
    to 3; ``digits=None`` keeps it unrounded).
    """
    def s(k, y):
        return F.sum(F.when((F.col(kind) == F.lit(k)) & (F.col(time) == F.lit(y)), F.col(value)))

    ga = (s(a, cur) - s(a, prev)) / F.nullif(s(a, prev), F.lit(0))
    gb = (s(b, cur) - s(b, prev)) / F.nullif(s(b, prev), F.lit(0))
    gap = ga - gb if digits is None else fround(ga - gb, digits)
    return df.agg(F.lit(cur).alias(time), ga.alias(f"growth_{a.lower()}"), gb.alias(f"growth_{b.lower()}"),
                  gap.alias("growth_gap"))


# ---------------------------------------------------------------- E17–E20
def global_summary(df: DataFrame, aggs: Sequence) -> DataFrame:
    """One summary row (percentiles allowed)."""
    return aggregate(df, [], aggs)


def summary_with(df: DataFrame, by: Sequence[str], aggs: Sequence, drivers: DataFrame) -> DataFrame:
    """Summary by type left-joined with a drivers table on the same keys."""
    return aggregate(df, by, aggs).join(drivers, list(by), "left")


def region_detail(df: DataFrame, by: Sequence[str], cols: Sequence[str], count_name: str = "n") -> DataFrame:
    """Median + count by region; a NULL region is its own group (dropna=False)."""
    return medians(df, by, cols, count_name=count_name)


def box_stats(df: DataFrame, by: Sequence[str], value: str, max_groups: int = 1_000_000) -> DataFrame:
    """Box-plot statistics per group.

    Quartiles are exact interpolating percentiles; whiskers are the most
    extreme values inside 1.5 IQR of the quartiles; outliers are counted.  Two
    passes: one aggregate for the quartiles, then a join back for whiskers
    and outlier counts.  The quartile table (one row per group) is written to
    the shared checkpoint folder and broadcast behind a row-count proof, so a
    hot group never meets a skewed shuffle join; joins are NULL-safe, so a
    NULL group is kept like any other (E19).
    """
    v = F.col(value)
    q = aggregate(df, by, [
        percentile_of(v, 0.25, "q1"), median_of(v, "median"), percentile_of(v, 0.75, "q3"),
        F.avg(v).alias("mean"), F.count(v).alias("n"),
    ]).withColumn("iqr", F.col("q3") - F.col("q1"))
    q = small_dim(checkpoint(q), max_groups)
    lo = F.col("q1") - F.lit(1.5) * F.col("iqr")
    hi = F.col("q3") + F.lit(1.5) * F.col("iqr")
    j = _null_safe_join(df.select(*by, value), q, list(by))
    inside = v.between(lo, hi)
    w = j.groupBy(*by).agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count(F.when(~inside, F.lit(1))).alias("n_outliers"),
    )
    return _join_keys(q.drop("iqr"), w, list(by))


def sum_cols(cols: Sequence[ColumnOrName]) -> Column:
    return functools.reduce(operator.add, [col(c) for c in cols])
