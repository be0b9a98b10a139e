"""Change decomposition and index series.

Plan shape (scale): all inputs are first reduced to a few rows per
(group, step) with partial aggregation, so the windows that rank, order
and accumulate steps run over a bounded set (groups × steps), never over
unit rows.  The only global (unpartitioned) window orders the *selected
steps* (at most top_n × groups rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint

from ..functions.columns import pct_text
from ..operators.aggregates import grouping_sets
from ..operators.joins import small_dim
from ..operators.reshape import to_long
from ..operators.sets import prefer_current, top_n_union
from ..operators.windows import cum_product, latest, ratio_to_first, rebase_at, rebase_first, running_sum


def driver_bridge(effects: DataFrame, group: str | None, step: str, delta: str, base: DataFrame, base_col: str,
                  total: DataFrame, total_col: str, top_n: int, remainder_label: str = "Other changes",
                  max_effects: int = 1_000_000, single_label: str = "all", group_name: str = "grp",
                  zero: Sequence[tuple] = ()) -> DataFrame:
    """Ranked drivers of a change with a running total and a remainder row.

    ``effects`` has (group, step, delta) rows (summed here); ``base`` has one
    base value per group; ``total`` one total relative change per group.
    effect = delta / base; top-n steps by |effect| per group, union of the
    groups' sets, ordered by mean |effect| over groups; cumulative effect per
    group; remainder = total − last cumulative, placed after the last step.

    ``group=None`` is the one-group variation: ``base`` and ``total`` are
    one-row frames used as scalar subqueries (no join on a constant key), and
    the output carries ``single_label`` in ``group_name``.  ``zero`` lists
    (group value, step) pairs whose effect is shown as 0 (after the steps are
    selected and ordered, before the running total), as the reference does
    for a step that does not apply to one valuation type.
    """
    single = group is None
    g = [] if single else [group]
    e = effects.groupBy(*g, step).agg(F.sum(delta).alias("__delta"))
    if single:
        e = e.select(step, (F.col("__delta") / F.nullif(base.select(base_col).scalar(), F.lit(0))).alias("effect"))
    else:
        e = e.join(base.select(group, F.col(base_col).alias("__base")), [group], "inner")
        e = e.select(group, step, (F.col("__delta") / F.nullif(F.col("__base"), F.lit(0))).alias("effect"))
    # (group, step) effects are few; write them once to the shared checkpoint
    # folder so the ranking, ordering, running total and remainder below read
    # this small table instead of re-running the heavy input plan each time.
    e = small_dim(checkpoint(e), max_effects)
    order = top_n_union(e, g, step, "effect", top_n).withColumnRenamed("item_order", "step_order")
    sel = e.join(order, [step], "inner")
    if zero and not single:
        hit = None
        for gv, sv in zero:
            c = (F.col(group) == F.lit(gv)) & (F.col(step) == F.lit(sv))
            hit = c if hit is None else hit | c
        sel = sel.withColumn("effect", F.when(hit, F.lit(0.0)).otherwise(F.col("effect")))
    sel = sel.withColumn("cumulative", running_sum("effect", g, "step_order"))
    last = latest(sel, g, [F.col("step_order").desc()]).select(*g, F.col("cumulative").alias("__last"))
    max_order = order.agg(F.max("step_order") + 1).scalar()
    if single:
        tot = total.select(total_col).scalar()
        rem = last.select(F.lit(remainder_label).alias(step), (tot - F.col("__last")).alias("effect"),
                          max_order.alias("step_order"), tot.alias("cumulative"))
        out = sel.select(step, "effect", "step_order", "cumulative").unionByName(rem)
        out = out.select(F.lit(single_label).alias(group_name), "*")
    else:
        rem = (
            total.select(group, F.col(total_col).alias("__total"))
            .join(last, [group], "inner")
            .select(group, F.lit(remainder_label).alias(step), (F.col("__total") - F.col("__last")).alias("effect"),
                    max_order.alias("step_order"), F.col("__total").alias("cumulative"))
        )
        out = sel.select(group, step, "effect", "step_order", "cumulative").unionByName(rem)
    return out.select("*", pct_text("effect").alias("effect_text"), pct_text("cumulative").alias("cumulative_text"))


def waterfall(df: DataFrame, cls: str, listed: Sequence[str], steps: Sequence[tuple[str, str]],
              total_label: str = "Total") -> DataFrame:
    """Mean per step by class plus a total class, percent of the first step, measure kind.

    ``steps`` are (label, column) in order.  The total rows cover *all* rows
    while class rows are kept only for ``listed`` classes (Q9), from one
    GROUPING SETS aggregate.
    """
    aggs = [F.avg(c).alias(f"__s{i}") for i, (_, c) in enumerate(steps, start=1)]
    g = grouping_sets(df, [[cls], []], aggs, labels={cls: total_label}, keep_levels=True)
    g = g.filter((F.col("grouping_id") == 1) | F.col(cls).isin(list(listed))).drop("grouping_id")
    rows = [(lab, F.col(f"__s{i}"), i) for i, (lab, _) in enumerate(steps, start=1)]
    long = to_long(g, [cls], rows, ["step", "value", "step_order"])
    n = len(steps)
    pct = ratio_to_first("value", [cls], "step_order")
    return long.select(
        cls, "step", "value", pct.alias("percent"), pct_text(pct).alias("text"), "step_order",
        F.when(F.col("step_order") == 1, F.lit("absolute")).when(F.col("step_order") == n, F.lit("total"))
        .otherwise(F.lit("relative")).alias("measure"),
    )


def waterfall_by_company(df: DataFrame, company: str, base: str, parts: Sequence[str], total: str) -> DataFrame:
    """Mean per company; each part relative to the mean base value."""
    aggs = [F.avg(c).alias(c) for c in [base, *parts, total]]
    g = df.groupBy(company).agg(*aggs)
    return g.select(company, base, *[(F.col(c) / F.nullif(F.col(base), F.lit(0))).alias(c) for c in parts], total)


def waterfall_steps(wide: DataFrame, company: str, parts: Sequence[str], exclusions: DataFrame | None = None) -> DataFrame:
    """I13 long form: one row per (company, step) with per-step exclusions (C20)."""
    from ..functions.predicates import exclude_steps

    long = to_long(wide, [company], [(p, F.col(p), i) for i, p in enumerate(parts, start=1)], ["step", "value", "step_order"])
    if exclusions is not None:
        long = exclude_steps(long, exclusions, "step", company)
    return long


def cumulative_index(rates: DataFrame, series: str, time: str, rate: str, bases: Sequence[int]) -> DataFrame:
    """Index 100·Π(1+r) per series, rebased to the first year and to given years."""
    idx = cum_product(rate, [series], time) * F.lit(100)
    out = rates.select(series, time, rate, (F.col(rate) + F.lit(1)).alias("index_change"), idx.alias("index"),
                       pct_text(rate).alias("text"))
    cols = [rebase_first("index", [series], time).alias("index_base_first")]
    cols += [rebase_at("index", [series], time, b).alias(f"index_base_{b}") for b in bases]
    return out.select("*", *cols)


def series_with_history(current: DataFrame, history: DataFrame, keys: Sequence[str], time: str, cur) -> DataFrame:
    """H7: current source first; history only below the current year and for absent keys."""
    return prefer_current(current, history, keys, time, cur)


__all__ = ["driver_bridge", "waterfall", "waterfall_by_company", "waterfall_steps", "cumulative_index",
           "series_with_history"]
