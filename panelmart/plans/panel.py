"""Year-over-year panel analyses.

Plan shape (scale): the panel is one full outer join of two *year slices* of
the fact on the unit key, i.e. one shuffle of each slice on (unit, company);
when the fact is stored partitioned by year, each slice reads one folder.
Everything after it is per-row work (unpivot = a generator, change columns
= projections) followed by one partial+final aggregate on a handful of
low-cardinality keys, so the data that crosses the network after the join
is a few rows per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import abs_change, as_index, col, pct_text, rel_change
from ..operators.aggregates import TOTAL, Derived, aggregate, median_of, with_totals
from ..operators.joins import MERGE_COL, indicator_merge
from ..operators.reshape import to_long


def prior_name(c: str, prev, aliases: Mapping[str, str] | None = None) -> str:
    return f"{(aliases or {}).get(c, c)}_{prev}"


def yoy_panel(fact: DataFrame, keys: Sequence[str], time: str, cur: int, cols: Sequence[str],
              aliases: Mapping[str, str] | None = None, keys_mode: str = "coalesce") -> DataFrame:
    """Current-year slice ⟗ prior-year slice on the unit keys.

    All current columns keep their names; ``cols`` of the prior year are added
    as ``<alias>_<prior year>``; ``_merge`` tells both / left_only / right_only.
    """
    prev = cur - 1
    y0 = fact.filter(F.col(time) == F.lit(cur))
    ym1 = fact.filter(F.col(time) == F.lit(prev)).select(
        *keys, *[F.col(c).alias(prior_name(c, prev, aliases)) for c in cols]
    )
    return indicator_merge(y0, ym1, keys, keys=keys_mode)


def matched(panel: DataFrame, same: Sequence[tuple[str, str]] = (), pred: Column | None = None) -> DataFrame:
    """Rows present in both years, with equal attributes (e.g. same model) and an extra predicate."""
    cond = F.col(MERGE_COL) == F.lit("both")
    for a, b in same:
        cond = cond & (F.col(a) == F.col(b))
    if pred is not None:
        cond = cond & pred
    return panel.filter(cond)


def value_change(panel: DataFrame, specs: Sequence[tuple], type_col: str, type_prev_col: str, time: str,
                 unit: str, by: Sequence[str] = (), totals: bool = False, total_label: str = TOTAL) -> DataFrame:
    """Unpivot value kinds, keep comparable rows, mean current / prior, change columns.

    ``specs`` rows are ``(kind, type, current_col, prior_col, require_same_type)``
    where ``type`` is a column name or a fixed label.  A row is used when both
    values are present and, if required, the unit's type did not change.
    ``by`` adds grouping keys (e.g. region); with ``totals`` each of them also
    gets a total row (GROUPING SETS, one scan).
    """
    rows = []
    for kind, typ, cur_c, prev_c, same in specs:
        t = F.col(typ) if typ in panel.columns else F.lit(typ)
        rows.append((F.lit(kind), t, F.col(cur_c), F.col(prev_c), F.lit(bool(same))))
    long = to_long(panel, [unit, time, type_col, type_prev_col, *by], rows,
                   ["value_kind", "value_type", "value_current", "value_prior", "__same"])
    long = long.filter(
        F.col("value_current").isNotNull() & F.col("value_prior").isNotNull()
        & (~F.col("__same") | (F.col(type_col) == F.col(type_prev_col)))
    )
    aggs = [
        F.avg("value_current").alias("value_current"),
        F.avg("value_prior").alias("value_prior"),
        F.count(unit).alias("n_units"),
    ]
    keys = ["value_kind", "value_type", time]
    if totals and by:
        g = with_totals(long, keys, list(by), aggs, total_label=total_label)
    else:
        g = long.groupBy(*keys, *by).agg(*aggs)
    return add_change_columns(g, "value_current", "value_prior")


def add_change_columns(df: DataFrame, cur: str, prev: str, prefix: str = "") -> DataFrame:
    """C12–C14 on an aggregate: absolute, relative, index and text."""
    rel = rel_change(cur, prev)
    return df.select(
        "*",
        abs_change(cur, prev).alias(f"{prefix}abs_change"),
        rel.alias(f"{prefix}rel_change"),
        as_index(rel).alias(f"{prefix}index_change"),
        pct_text(rel).alias(f"{prefix}change_text"),
    )


def region_change(panel: DataFrame, by: Sequence[str], region: str, cur: str, prev: str,
                  how: str = "difference_of_medians", total_label: str = TOTAL) -> DataFrame:
    """Medians of current, prior and their change by region, with total rows."""
    if how == "difference_of_medians":
        change = Derived([], (F.col("median_current") - F.col("median_prior")).alias("median_change"))
    else:
        change = median_of(col(cur) - col(prev), "median_change")
    aggs = [
        median_of(cur, "median_current"),
        median_of(prev, "median_prior"),
        change,
        F.count(F.lit(1)).alias("n_units"),
    ]
    return with_totals(panel, by, [region], aggs, total_label=total_label)


def category_mix(df: DataFrame, by: Sequence[str], cat: str) -> DataFrame:
    """Count and share of each category within ``by`` groups."""
    counts = df.groupBy(*by, cat).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.groupBy(*by).agg(F.sum("n").alias("__t")) if by else None
    if by:
        out = counts.join(tot, list(by), "inner")
    else:
        out = counts.withColumn("__t", counts.agg(F.sum("n")).scalar())
    return out.withColumn("share", F.col("n") / F.nullif(F.col("__t"), F.lit(0))).drop("__t")


def category_mix_yoy(df: DataFrame, time: str, cur: int, cat: str, by: Sequence[str] = ()) -> DataFrame:
    """I21 YoY: shares of the current and prior year side by side (full outer), share change."""
    c = category_mix(df.filter(F.col(time) == cur), by, cat).select(*by, cat, F.col("n").alias("n_current"), F.col("share").alias("share_current"))
    p = category_mix(df.filter(F.col(time) == cur - 1), by, cat).select(*by, cat, F.col("n").alias("n_prior"), F.col("share").alias("share_prior"))
    j = indicator_merge(c, p, [*by, cat]).drop(MERGE_COL)
    return j.withColumn(
        "share_change", F.coalesce(F.col("share_current"), F.lit(0.0)) - F.coalesce(F.col("share_prior"), F.lit(0.0))
    )


def scenario_share(df: DataFrame, by: Sequence[str], flag: Column, total_dims: Sequence[str] = (), name: str = "share") -> DataFrame:
    """Share of rows with a scenario flag by type and region (with totals)."""
    aggs = [
        F.count(F.when(flag, F.lit(1))).alias("n_flagged"),
        F.count(F.lit(1)).alias("n"),
        (F.count(F.when(flag, F.lit(1))) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias(name),
    ]
    if total_dims:
        return with_totals(df, by, total_dims, aggs)
    return df.groupBy(*by).agg(*aggs)


def scenario_share_yoy(df: DataFrame, by: Sequence[str], time: str, cur: int, flag: Column) -> DataFrame:
    """I24 + D12: share in the current and prior year per group, and its change (inner join)."""
    s = df.filter(F.col(time).isin(cur, cur - 1)).groupBy(*by, time).agg(
        (F.count(F.when(flag, F.lit(1))) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("share")
    )
    c = s.filter(F.col(time) == cur).select(*by, F.col("share").alias("share_current"))
    p = s.filter(F.col(time) == cur - 1).select(*by, F.col("share").alias("share_prior"))
    return c.join(p, list(by), "inner").withColumn("share_change", F.col("share_current") - F.col("share_prior"))


def trend_lines(df: DataFrame, time: str, years: Sequence[int], kind: str, value: str, a: str, b: str) -> DataFrame:
    """Median per (year, kind) for the given years, plus the a − b gap per year."""
    med = aggregate(df.filter(F.col(time).isin(list(years))), [time, kind], [median_of(value, "median_value")])
    wide = med.groupBy(time).pivot(kind, [a, b]).agg(F.first("median_value"))
    return wide.select(time, F.col(a).alias(f"median_{a.lower()}"), F.col(b).alias(f"median_{b.lower()}"),
                       (F.col(a) - F.col(b)).alias("gap"))


__all__ = [
    "yoy_panel", "matched", "value_change", "add_change_columns", "region_change", "category_mix",
    "category_mix_yoy", "scenario_share", "scenario_share_yoy", "trend_lines",
]
