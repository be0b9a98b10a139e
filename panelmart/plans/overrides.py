"""Override ("degree of freedom") analyses.

The reference repeats one filtered aggregate per override configuration
and stacks them with UNION ALL (10–20 scans of the same prepared table).
Here every configuration is a *filter column*: one ``groupBy`` computes the
conditional aggregates of all configurations in a single scan (R7), and a
generator emits one row per (group, configuration, value kind).  A group
with no row for a configuration is dropped by that configuration's
conditional count, exactly like an empty UNION arm.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bin_between, count_positive, equal_at
from ..functions.predicates import drop_sentinel, outside, same_flag, scenario_ok, within
from ..operators.reshape import to_long


@dataclass
class OverrideConfig:
    """One override configuration (the reference's per-chart macro arguments)."""
    name: str
    value: str                      # measure column (current year)
    prior: str                      # same measure, prior year
    basic: str | None = None        # handbook variant of the measure
    basic_prior: str | None = None
    diff: str = "abs"               # 'abs' or 'rel'
    use_flag: tuple[str, str] | None = None   # (current flag col, prior flag col) that must match
    own_value: object = None        # with use_flag: both must equal this value (b_full)
    scenario: tuple[str, str, str, str, object] | None = None  # (src, code, src_prior, code_prior, excluded code)
    scenario_source_value: object = None
    rate: bool = False              # sentinel filter (<= 1.0) on value and basic, both years
    extra: list[Column] = field(default_factory=list)

    def filter(self, exclusions_ok: Column | None = None) -> Column:
        cond = F.lit(True)
        if self.use_flag:
            cond = cond & same_flag(self.use_flag[0], self.use_flag[1])
            if self.own_value is not None:
                cond = cond & (F.col(self.use_flag[0]) == F.lit(self.own_value)) & (F.col(self.use_flag[1]) == F.lit(self.own_value))
        if self.scenario:
            src, code, src_p, code_p, excluded = self.scenario
            cond = cond & scenario_ok(src, code, self.scenario_source_value, excluded, null_safe=False)
            cond = cond & scenario_ok(src_p, code_p, self.scenario_source_value, excluded, null_safe=False)
        if self.rate:
            cols = [self.value, self.prior] + ([self.basic, self.basic_prior] if self.basic else [])
            cond = cond & drop_sentinel(cols, 1.0)
        for e in self.extra:
            cond = cond & e
        if exclusions_ok is not None:
            cond = cond & exclusions_ok
        return cond


def _change(cur: Column, prev: Column, diff: str) -> Column:
    return cur - prev if diff == "abs" else (cur - prev) / F.nullif(prev, F.lit(0))


def with_exclusions(df: DataFrame, company: str, exclusions: DataFrame, configs: Sequence[OverrideConfig],
                    measure: str = "measure", ex_company: str = "company", year: str = "year", cur_year=None) -> DataFrame:
    """D9 per configuration: add ``__ok_<name>`` = company NOT IN (listed for that measure and year).

    SQL's null-aware NOT IN: an empty list lets every row pass; a list with a
    NULL lets none pass; a NULL company passes only an empty list.  The
    (small) list is left-joined to the rows once per configuration and its
    emptiness / NULL flags are scalar subqueries, so the rows are read once
    and stay on the executors.
    """
    out = df
    for cfg in configs:
        filt = F.col(measure) == F.lit(cfg.value)
        if cur_year is not None:
            filt = filt & (F.col(year) == F.lit(cur_year))
        lst = exclusions.filter(filt).select(F.col(ex_company).alias("__nk"))
        has_rows = lst.agg((F.count(F.lit(1)) > 0).alias("r")).scalar()
        has_null = lst.agg((F.count(F.lit(1)) > F.count("__nk")).alias("n")).scalar()
        hits = lst.filter(F.col("__nk").isNotNull()).distinct().withColumn("__hit", F.lit(True))
        out = out.join(hits, F.col(company) == F.col("__nk"), "left")
        ok = (~has_rows) | (~has_null & F.col(company).isNotNull() & F.col("__hit").isNull())
        out = out.withColumn(f"__ok_{cfg.name}", F.coalesce(ok, F.lit(False))).drop("__nk", "__hit")
    return out


def _ok(cfg: OverrideConfig, df: DataFrame) -> Column | None:
    c = f"__ok_{cfg.name}"
    return F.col(c) if c in df.columns else None


def override_change(df: DataFrame, by: str, type_col: str, configs: Sequence[OverrideConfig],
                    basis: str = "Basis", full: str = "Full", handbook_label: str = "Full (handbook)") -> DataFrame:
    """I16 (+G3/G6/E10): change of the mean by area for Basis, Full and Full-handbook, all configs in one scan."""
    aggs, rows = [], []
    for i, cfg in enumerate(configs):
        f = cfg.filter(_ok(cfg, df))
        is_b, is_f = F.col(type_col) == basis, F.col(type_col) == full

        def a(x, t, _f=f):
            return F.avg(F.when(_f & t, F.col(x)))

        aggs += [F.count(F.when(f, F.lit(1))).alias(f"__n{i}"),
                 a(cfg.value, is_b).alias(f"__bc{i}"), a(cfg.prior, is_b).alias(f"__bp{i}"),
                 a(cfg.value, is_f).alias(f"__fc{i}"), a(cfg.prior, is_f).alias(f"__fp{i}"),
                 a(cfg.basic or cfg.value, is_f).alias(f"__hc{i}"), a(cfg.basic_prior or cfg.prior, is_f).alias(f"__hp{i}")]
        for label, c, p in ((basis, "__bc", "__bp"), (full, "__fc", "__fp"), (handbook_label, "__hc", "__hp")):
            rows.append((F.lit(cfg.name), F.lit(label), _change(F.col(f"{c}{i}"), F.col(f"{p}{i}"), cfg.diff), F.col(f"__n{i}")))
    wide = df.groupBy(by).agg(*aggs)
    long = to_long(wide, [by], rows, ["config", "valuation_type", "value", "__n"])
    return long.filter(F.col("__n") > 0).drop("__n")


def override_level_and_change(df: DataFrame, company: str, type_col: str, configs: Sequence[OverrideConfig],
                              handbook_label: str = "Full (handbook)") -> DataFrame:
    """Per company and type, level (mean) and change rows from one aggregate, all configs.

    A configuration with a handbook column also gives a level row of that column per
    company (all types together), labelled ``handbook_label``.
    """
    aggs, rows = [], []
    for i, cfg in enumerate(configs):
        f = cfg.filter(_ok(cfg, df))
        cur = F.avg(F.when(f, F.col(cfg.value)))
        prev = F.avg(F.when(f, F.col(cfg.prior)))
        aggs += [F.count(F.when(f, F.lit(1))).alias(f"__n{i}"), cur.alias(f"__lv{i}"),
                 _change(cur, prev, cfg.diff).alias(f"__ch{i}")]
        rows.append((F.lit(cfg.name), F.lit("level"), F.col(f"__lv{i}"), F.col(f"__n{i}")))
        rows.append((F.lit(cfg.name), F.lit("change"), F.col(f"__ch{i}"), F.col(f"__n{i}")))
    wide = df.groupBy(company, type_col).agg(*aggs)
    long = to_long(wide, [company, type_col], rows, ["config", "calc_type", "value", "__n"])
    books = [(i, cfg) for i, cfg in enumerate(configs) if cfg.basic]
    if books:
        flags = {i: cfg.filter(_ok(cfg, df)) for i, cfg in books}
        level = df.groupBy(company).agg(
            *[F.count(F.when(flags[i], F.lit(1))).alias(f"__n{i}") for i, _ in books],
            *[F.avg(F.when(flags[i], F.col(cfg.basic))).alias(f"__hb{i}") for i, cfg in books])
        hand = [(F.lit(cfg.name), F.lit("level"), F.col(f"__hb{i}"), F.col(f"__n{i}")) for i, cfg in books]
        level = to_long(level, [company], hand, ["config", "calc_type", "value", "__n"]).withColumn(type_col, F.lit(handbook_label))
        long = long.unionByName(level)
    return long.filter(F.col("__n") > 0).drop("__n")


def override_box(df: DataFrame, company: str, type_col: str, configs: Sequence[OverrideConfig],
                 basis: str = "Basis", full: str = "Full", handbook_label: str = "Full (handbook)",
                 diff_label: str = "Difference") -> DataFrame:
    """Nine rows per company and config (current, prior, difference per type); empty types dropped."""
    aggs, rows = [], []
    for i, cfg in enumerate(configs):
        f = cfg.filter(_ok(cfg, df))
        is_b, is_f = F.col(type_col) == basis, F.col(type_col) == full
        n_f = F.count(F.when(f & is_f, F.lit(1)))
        n_b = F.count(F.when(f & is_b, F.lit(1)))

        def a(x, t, _f=f):
            return F.avg(F.when(_f & t, F.col(x)))

        fc, fp = a(cfg.value, is_f), a(cfg.prior, is_f)
        hc, hp = a(cfg.basic or cfg.value, is_f), a(cfg.basic_prior or cfg.prior, is_f)
        bc, bp = a(cfg.value, is_b), a(cfg.prior, is_b)
        named = {"nf": n_f, "nb": n_b, "fc": fc, "fp": fp, "hc": hc, "hp": hp, "bc": bc, "bp": bp,
                 "fd": _change(fc, fp, cfg.diff), "hd": _change(hc, hp, cfg.diff), "bd": _change(bc, bp, cfg.diff)}
        aggs += [v.alias(f"__{k}{i}") for k, v in named.items()]
        spec = [(full, "current", "fc", "nf"), (full, "prior", "fp", "nf"), (handbook_label, "current", "hc", "nf"),
                (handbook_label, "prior", "hp", "nf"), (full, diff_label, "fd", "nf"), (handbook_label, diff_label, "hd", "nf"),
                (basis, "current", "bc", "nb"), (basis, "prior", "bp", "nb"), (basis, diff_label, "bd", "nb")]
        for t, kind, v, n in spec:
            rows.append((F.lit(cfg.name), F.lit(t), F.lit(kind), F.col(f"__{v}{i}"), F.col(f"__{n}{i}")))
    wide = df.groupBy(company).agg(*aggs)
    long = to_long(wide, [company], rows, ["config", "valuation_type", "measure", "value", "__n"])
    return long.filter(F.col("__n") > 0).drop("__n")


def override_usage(df: DataFrame, by: str, flags: Sequence[tuple[str, Column]], total_label: str = "Total") -> DataFrame:
    """Share of rows using each override (own input), by type and in total.

    One GROUPING SETS aggregate computes every flag's share (E10 form), then
    a generator emits one row per (group, override).
    """
    from ..operators.aggregates import grouping_sets

    aggs = [F.avg(F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))).alias(f"__s{i}") for i, (_, c) in enumerate(flags)]
    g = grouping_sets(df, [[by], []], [*aggs, F.count(F.lit(1)).alias("n")], labels={by: total_label})
    rows = [(F.lit(name), F.col(f"__s{i}")) for i, (name, _) in enumerate(flags)]
    return to_long(g, [by, "n"], rows, ["override", "share_own_input"])


def realised_vs_expected(cur: DataFrame, prev: DataFrame, params: DataFrame, on: Sequence[str], company: str,
                         value: str, prev_value: str, expected: str, lo: float, hi: float, target: str | None = None) -> DataFrame:
    """Measured growth − expected growth per unit; median, mean, n, equality and range shares per company.

    ``*_within``: the deviations of the units whose measured growth lies in
    [lo, hi]; ``share_target_outside`` (with ``target``): of the units outside it, the
    share whose value equals the target to the cent.
    """
    j = cur.join(prev, list(on), "inner").join(params, list(on), "inner")
    measured = (F.col(value) - F.col(prev_value)) / F.nullif(F.col(prev_value), F.lit(0))
    hit = [equal_at(value, target, 2).alias("hit")] if target else []
    j = j.select(company, measured.alias("measured"), F.col(expected).alias("expected"), *hit)
    from ..operators.aggregates import aggregate, median_of

    dev = F.col("measured") - F.col("expected")
    return aggregate(j, [company], [
        median_of(dev, "median_deviation"),
        F.avg(dev).alias("mean_deviation"),
        F.count(F.lit(1)).alias("n_units"),
        F.avg(equal_at("measured", "expected", 2).cast("double")).alias("share_equal"),
        F.count(F.when(within("measured", lo, hi), F.lit(1))).alias("n_within"),
        F.count(F.when(outside("measured", lo, hi), F.lit(1))).alias("n_outside"),
        median_of((F.col("measured") - F.col("expected")) / F.nullif(F.col("expected"), F.lit(0)), "median_rel_error"),
        median_of(F.when(within("measured", lo, hi), dev), "median_within"),
        F.avg(F.when(within("measured", lo, hi), dev)).alias("mean_within"),
        *([F.avg(F.when(outside("measured", lo, hi), F.col("hit").cast("double"))).alias("share_target_outside")] if target else []),
    ])


def plan_length(df: DataFrame, year_cols: Sequence[str], ranges: Sequence[tuple[float, float, str]], by: Sequence[str] = ()) -> DataFrame:
    """Number of positive yearly columns per row, binned (label, order), counted."""
    lab, order = bin_between(count_positive(year_cols), ranges)
    return df.select(*by, lab.alias("bin"), order.alias("bin_order")).groupBy(*by, "bin", "bin_order").agg(
        F.count(F.lit(1)).alias("n"))


def coverage(sample: DataFrame, population: DataFrame, by: Sequence[str], sample_n: str, pop_n: str) -> DataFrame:
    """Sample units / population units by area (full outer of the two aggregates)."""
    from ..operators.joins import MERGE_COL, indicator_merge

    j = indicator_merge(sample, population, list(by)).drop(MERGE_COL)
    return j.withColumn("coverage", F.col(sample_n) / F.nullif(F.col(pop_n), F.lit(0)))


def region_fill(values: DataFrame, regions: DataFrame, on: Sequence[str], flag: str = "no_data") -> DataFrame:
    """Every region of the boundary table, flagged when it has no value row."""
    from ..operators.joins import fill_regions

    return fill_regions(values, regions, on, flag)


__all__ = ["OverrideConfig", "override_change", "override_level_and_change", "override_box", "override_usage",
           "realised_vs_expected", "plan_length", "coverage", "region_fill", "with_exclusions"]
