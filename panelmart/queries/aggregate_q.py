"""Aggregation and totals queries: E1–E19, I9, I10, I21, I24, I25, I27, I28, I29."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import fround, sql_fround
from ..operators import aggregates as A
from ..plans.panel import (
    category_mix_yoy, matched, region_change, scenario_share, scenario_share_yoy, trend_lines,
)
from ..registry import register
from .common import CUR, MEAN, MONEY, NET, PREV, RATIO, UY, UY_PANEL, fact, p, panel


def cur_fact(cat):
    return fact(cat, [CUR])


def _tot(d: str) -> str:
    return f"CASE WHEN grouping({d}) = 1 THEN 'Total' ELSE {d} END AS {d}"


# ---------------------------------------------------------------- E1
@register("summarise", UY + f"""
SELECT company, valuation_type, avg(market_value) AS avg_value, sum(market_value) AS sum_value,
       count(*) AS n_units, max(market_value) AS max_value
FROM unit_year WHERE year = {CUR} GROUP BY company, valuation_type""",
          digits={"avg_value": MEAN, "sum_value": MONEY, "max_value": MONEY}, ids=("E1",))
def q_summarise(cat):
    return A.summarise(cur_fact(cat), ["company", "valuation_type"], [
        F.avg("market_value").alias("avg_value"), F.sum("market_value").alias("sum_value"),
        F.count(F.lit(1)).alias("n_units"), F.max("market_value").alias("max_value"),
    ])


# ---------------------------------------------------------------- E2 / E5 / I9
@register("with_totals_median", UY + f"""
SELECT {_tot('unit_type')}, median(market_value) AS market_value_median,
       median(policy_value) AS policy_value_median, count(*) AS n
FROM unit_year WHERE year = {CUR} GROUP BY GROUPING SETS ((unit_type), ())""",
          digits={"market_value_median": MONEY, "policy_value_median": NET}, ids=("I9", "E2", "E5", "E8"))
def q_with_totals_median(cat):
    return A.with_totals(cur_fact(cat), [], ["unit_type"], [
        A.median_of("market_value", "market_value_median"),
        A.median_of("policy_value", "policy_value_median"),
        F.count(F.lit(1)).alias("n"),
    ])


# ---------------------------------------------------------------- E6
@register("totals_2x2", UY + f"""
SELECT {_tot('valuation_type')}, {_tot('unit_type')}, avg(market_value) AS avg_value, count(*) AS n
FROM unit_year WHERE year = {CUR}
GROUP BY GROUPING SETS ((valuation_type, unit_type), (unit_type), (valuation_type), ())""",
          digits={"avg_value": MEAN}, ids=("E6",))
def q_totals_2x2(cat):
    return A.with_totals(cur_fact(cat), [], ["valuation_type", "unit_type"], [
        F.avg("market_value").alias("avg_value"), F.count(F.lit(1)).alias("n")])


# ---------------------------------------------------------------- E7
@register("region_national", UY + f"""
SELECT {_tot('unit_type')}, {_tot('region')},
       avg(CASE WHEN valuation_type = 'Full' THEN 1.0 ELSE 0.0 END) AS pct_full_valued, count(*) AS n
FROM unit_year WHERE year = {CUR}
GROUP BY GROUPING SETS ((unit_type, region), (unit_type), ())""",
          digits={"pct_full_valued": RATIO}, ids=("E7",))
def q_region_national(cat):
    full = F.when(F.col("valuation_type") == "Full", F.lit(1.0)).otherwise(F.lit(0.0))
    return A.with_totals(cur_fact(cat), ["unit_type"], ["region"], [
        F.avg(full).alias("pct_full_valued"), F.count(F.lit(1)).alias("n")], national=True)


# ---------------------------------------------------------------- E8 / E9 / I28
@register("energy_share", UY + f"""
SELECT {_tot('region')},
       count(*) FILTER (WHERE n_orders > 1) / count(*) AS share_all,
       count(*) FILTER (WHERE n_orders > 1 AND policy_value IS NOT NULL AND NOT isnan(policy_value))
         / nullif(count(*) FILTER (WHERE policy_value IS NOT NULL AND NOT isnan(policy_value)), 0) AS share_valid,
       count(*) AS n_all,
       count(*) FILTER (WHERE policy_value IS NOT NULL AND NOT isnan(policy_value)) AS n_valid
FROM unit_year WHERE year = {CUR}
GROUP BY GROUPING SETS ((region), ())""",
          digits={"share_all": RATIO, "share_valid": RATIO}, ids=("I28", "E8", "E9", "H11"))
def q_energy_share(cat):
    from ..functions.columns import is_valid_number

    hit = F.col("n_orders") > 1
    valid = is_valid_number("policy_value")
    return A.grouping_sets(cur_fact(cat), [["region"], []], [
        (A.count_where(hit) / F.count(F.lit(1))).alias("share_all"),
        (A.count_where(hit & valid) / F.nullif(A.count_where(valid), F.lit(0))).alias("share_valid"),
        F.count(F.lit(1)).alias("n_all"),
        A.count_where(valid).alias("n_valid"),
    ])


# ---------------------------------------------------------------- E3 / E4
@register("median_forms", UY_PANEL + f"""
SELECT unit_type,
       median(market_value) - median({p('market_value')}) AS diff_of_medians,
       median(market_value - {p('market_value')}) AS median_of_diffs,
       median(policy_value) / nullif(median(market_value), 0) AS ratio_of_medians,
       median(policy_value / nullif(market_value, 0)) AS median_of_ratios,
       avg(policy_value) / nullif(avg(market_value), 0) AS ratio_of_means,
       count(*) AS n
FROM panel WHERE _merge = 'both' GROUP BY unit_type""",
          digits={"diff_of_medians": MONEY, "median_of_diffs": MONEY, "ratio_of_medians": RATIO,
                  "median_of_ratios": RATIO, "ratio_of_means": RATIO}, ids=("E3", "E4"))
def q_median_forms(cat):
    m = matched(panel(cat))
    return A.aggregate(m, ["unit_type"], [
        A.median_change("market_value", p("market_value"), "difference_of_medians", "diff_of_medians"),
        A.median_change("market_value", p("market_value"), "median_of_differences", "median_of_diffs"),
        A.ratio("policy_value", "market_value", "ratio_of_medians", "ratio_of_medians"),
        A.ratio("policy_value", "market_value", "median_of_ratios", "median_of_ratios"),
        A.ratio("policy_value", "market_value", "ratio_of_means", "ratio_of_means"),
        F.count(F.lit(1)).alias("n"),
    ])


# ---------------------------------------------------------------- I10
@register("region_change", UY_PANEL + f"""
SELECT {_tot('region')}, unit_type,
       median(market_value) AS median_current, median({p('market_value')}) AS median_prior,
       median(market_value) - median({p('market_value')}) AS median_change, count(*) AS n_units
FROM panel WHERE _merge = 'both'
GROUP BY GROUPING SETS ((unit_type, region), (unit_type))""",
          digits={"median_current": MONEY, "median_prior": MONEY, "median_change": MONEY}, ids=("I10", "E3", "I9"))
def q_region_change(cat):
    return region_change(matched(panel(cat)), ["unit_type"], "region", "market_value", p("market_value"))


@register("region_change_of_diffs", UY_PANEL + f"""
SELECT {_tot('region')}, unit_type,
       median(policy_value) AS median_current, median({p('policy_value')}) AS median_prior,
       median(policy_value - {p('policy_value')}) AS median_change, count(*) AS n_units
FROM panel WHERE _merge = 'both' AND policy_value IS NOT NULL AND {p('policy_value')} IS NOT NULL
GROUP BY GROUPING SETS ((unit_type, region), (unit_type))""",
          digits={"median_current": NET, "median_prior": NET, "median_change": NET}, ids=("I10", "E3"))
def q_region_change_of_diffs(cat):
    m = matched(panel(cat), pred=F.col("policy_value").isNotNull() & F.col(p("policy_value")).isNotNull())
    return region_change(m, ["unit_type"], "region", "policy_value", p("policy_value"), how="median_of_differences")


# ---------------------------------------------------------------- E9 / E10 / E15
@register("conditional_aggs", UY + f"""
SELECT region,
       count(*) FILTER (WHERE own_input = 1) AS n_own_input,
       avg(market_value) FILTER (WHERE valuation_type = 'Full') AS avg_full,
       avg(CASE WHEN valuation_type = 'Basis' THEN market_value END) AS pivot_basis,
       avg(CASE WHEN valuation_type = 'Full' THEN market_value END) AS pivot_full,
       count(*) FILTER (WHERE own_input = 1) / nullif(count(*), 0) AS share_own_input
FROM unit_year WHERE year = {CUR} GROUP BY region""",
          digits={"avg_full": MEAN, "pivot_basis": MEAN, "pivot_full": MEAN, "share_own_input": RATIO},
          ids=("E9", "E10", "E15"))
def q_conditional_aggs(cat):
    own = F.col("own_input") == 1
    return cur_fact(cat).groupBy("region").agg(
        A.count_where(own).alias("n_own_input"),
        A.avg_where("market_value", F.col("valuation_type") == "Full").alias("avg_full"),
        *A.pivot_avg("market_value", "valuation_type", ["Basis", "Full"], ["pivot_basis", "pivot_full"]),
        A.share_where(own).alias("share_own_input"),
    )


# ---------------------------------------------------------------- E12 / E13
@register("having_label", UY + f"""
SELECT complex, company, CASE WHEN n_orders > 1 THEN 'multi' ELSE 'single' END AS order_class,
       count(*) AS n, sum(market_value) AS sum_value, avg(market_value) AS avg_value
FROM unit_year WHERE year = {CUR}
GROUP BY complex, company, order_class HAVING count(*) > 1""",
          digits={"sum_value": MONEY, "avg_value": MEAN}, ids=("E12", "E13"))
def q_having_label(cat):
    label = F.when(F.col("n_orders") > 1, F.lit("multi")).otherwise(F.lit("single"))
    agg = A.summarise_by_label(cur_fact(cat), label, "order_class", ["complex", "company"], [
        F.count(F.lit(1)).alias("n"), F.sum("market_value").alias("sum_value"), F.avg("market_value").alias("avg_value"),
    ])
    return A.having(agg, F.col("n") > 1)


# ---------------------------------------------------------------- E14
@register("classify_group", UY + f"""
SELECT company, CASE WHEN sum(CASE WHEN valuation_type = 'Basis' THEN 1 ELSE 0 END) = 0 THEN 'Full' ELSE 'Basis' END AS company_class
FROM unit_year WHERE year = {CUR} AND complex = 'AUTOMOBILE' GROUP BY company""", ids=("E14",))
def q_classify_group(cat):
    df = cur_fact(cat).filter(F.col("complex") == "AUTOMOBILE")
    return A.classify_group(df, ["company"], F.when(F.col("valuation_type") == "Basis", 1).otherwise(0),
                            "company_class", "Full", "Basis")


# ---------------------------------------------------------------- E16 / I25 / H6 / H7
def _growth_rows(f, cur):
    return A.growth_gap(f, "year", cur, cur - 1, "market_value", "valuation_type", "Basis", "Full")


_GROWTH_SQL = """
SELECT {y} AS year,
  (sum(market_value) FILTER (WHERE valuation_type = 'Basis' AND year = {y})
   - sum(market_value) FILTER (WHERE valuation_type = 'Basis' AND year = {y} - 1))
   / nullif(sum(market_value) FILTER (WHERE valuation_type = 'Basis' AND year = {y} - 1), 0) AS growth_basis,
  (sum(market_value) FILTER (WHERE valuation_type = 'Full' AND year = {y})
   - sum(market_value) FILTER (WHERE valuation_type = 'Full' AND year = {y} - 1))
   / nullif(sum(market_value) FILTER (WHERE valuation_type = 'Full' AND year = {y} - 1), 0) AS growth_full
FROM unit_year"""


@register("growth_gap", UY + f"""
SELECT year, growth_basis, growth_full, {sql_fround("growth_basis - growth_full", 3)} AS growth_gap
FROM ({_GROWTH_SQL.format(y=CUR)}) g""",
          digits={"growth_basis": RATIO, "growth_full": RATIO, "growth_gap": RATIO}, ids=("E16", "I25"))
def q_growth_gap(cat):
    return _growth_rows(fact(cat), CUR)


@register("growth_gap_history", UY + f"""
, cur AS (SELECT year, growth_basis, growth_full, {sql_fround("growth_basis - growth_full", 3)} AS growth_gap
        FROM ({_GROWTH_SQL.format(y=CUR)}) g),
hist AS (
  SELECT y.year, (sb - pb) / nullif(pb, 0) AS growth_basis, (sf - pf) / nullif(pf, 0) AS growth_full,
         {sql_fround("(sb - pb) / nullif(pb, 0) - (sf - pf) / nullif(pf, 0)", 3)} AS growth_gap
  FROM (SELECT year, sum(market_value) FILTER (WHERE valuation_type = 'Basis') AS sb,
               sum(market_value) FILTER (WHERE valuation_type = 'Full') AS sf
        FROM unit_year GROUP BY year) y
  JOIN (SELECT year + 1 AS year, sum(market_value) FILTER (WHERE valuation_type = 'Basis') AS pb,
               sum(market_value) FILTER (WHERE valuation_type = 'Full') AS pf
        FROM unit_year GROUP BY year) q ON y.year = q.year
)
SELECT * FROM cur
UNION ALL
SELECT * FROM hist WHERE year <= {CUR} AND year NOT IN (SELECT year FROM cur)""",
          digits={"growth_basis": RATIO, "growth_full": RATIO, "growth_gap": RATIO}, ids=("I25", "H6", "H7"))
def q_growth_gap_history(cat):
    from ..operators.sets import prefer_current

    f = fact(cat)
    yearly = f.groupBy("year").agg(
        F.sum(F.when(F.col("valuation_type") == "Basis", F.col("market_value"))).alias("sb"),
        F.sum(F.when(F.col("valuation_type") == "Full", F.col("market_value"))).alias("sf"),
    )
    prev = yearly.select((F.col("year") + 1).alias("year"), F.col("sb").alias("pb"), F.col("sf").alias("pf"))
    h = yearly.join(prev, ["year"], "inner")
    gb = (F.col("sb") - F.col("pb")) / F.nullif(F.col("pb"), F.lit(0))
    gf = (F.col("sf") - F.col("pf")) / F.nullif(F.col("pf"), F.lit(0))
    history = h.select("year", gb.alias("growth_basis"), gf.alias("growth_full"), fround(gb - gf, 3).alias("growth_gap"))
    # The current row has the E16 definition; it is taken from the same yearly
    # aggregate (year from the data, so the precedence join keeps a real key).
    cur = history.filter(F.col("year") == CUR)
    return prefer_current(cur, history, ["year"], "year", CUR)


# ---------------------------------------------------------------- E17 / E18 / I26
@register("kpi_summary", UY_PANEL + f"""
, s AS (
  SELECT valuation_type, median(market_value) AS median_value, sum(market_value) AS total_value,
         count(*) AS n_units, sum(market_value) - sum({p('market_value')}) AS total_change
  FROM panel WHERE _merge = 'both' GROUP BY valuation_type
), d AS (
  SELECT valuation_type, avg(market_value / nullif({p('market_value')}, 0)) AS mean_growth_factor
  FROM panel WHERE _merge = 'both' GROUP BY valuation_type
)
SELECT s.*, d.mean_growth_factor,
       (SELECT median(market_value) FROM panel WHERE _merge = 'both') AS overall_median,
       (SELECT count(*) FROM panel WHERE _merge = 'both') AS overall_units
FROM s LEFT JOIN d USING (valuation_type)""",
          digits={"median_value": MONEY, "total_value": MONEY, "total_change": MONEY,
                  "mean_growth_factor": RATIO, "overall_median": MONEY}, ids=("I26", "E17", "E18", "D14"))
def q_kpi_summary(cat):
    from ..operators.joins import cross_scalar

    m = matched(panel(cat))
    drivers = m.groupBy("valuation_type").agg(
        F.avg(F.col("market_value") / F.nullif(F.col(p("market_value")), F.lit(0))).alias("mean_growth_factor"))
    s = A.summary_with(m, ["valuation_type"], [
        A.median_of("market_value", "median_value"), F.sum("market_value").alias("total_value"),
        F.count(F.lit(1)).alias("n_units"),
        (F.sum("market_value") - F.sum(p("market_value"))).alias("total_change"),
    ], drivers)
    overall = A.global_summary(m, [A.median_of("market_value", "overall_median"),
                                   F.count(F.lit(1)).alias("overall_units")])
    return cross_scalar(s, overall)


@register("kpi_summary_policy", UY_PANEL + f"""
, m AS (SELECT * FROM panel WHERE _merge = 'both' AND policy_value IS NOT NULL AND {p('policy_value')} IS NOT NULL),
seg AS (
  SELECT unit_type, median(policy_value) AS median_policy, median({p('policy_value')}) AS median_policy_prior,
         median(policy_value / nullif(market_value, 0)) AS median_policy_ratio, count(*) AS n_units
  FROM m GROUP BY unit_type
)
SELECT seg.*,
       (SELECT median(policy_value) FROM m) AS overall_median_policy,
       (SELECT (sum(policy_value) - sum({p('policy_value')})) / nullif(sum({p('policy_value')}), 0) FROM m) AS overall_policy_change
FROM seg""",
          digits={"median_policy": NET, "median_policy_prior": NET, "median_policy_ratio": RATIO,
                  "overall_median_policy": NET, "overall_policy_change": RATIO}, ids=("I26", "E17", "D14", "E4"))
def q_kpi_summary_policy(cat):
    """I26, policy variant: per-segment medians with the overall KPIs attached (separate frames joined
    by scalar subqueries, not the reference's segments × drivers product, Q12)."""
    from ..operators.joins import cross_scalar

    m = matched(panel(cat), pred=F.col("policy_value").isNotNull() & F.col(p("policy_value")).isNotNull())
    seg = A.aggregate(m, ["unit_type"], [
        A.median_of("policy_value", "median_policy"), A.median_of(p("policy_value"), "median_policy_prior"),
        A.ratio("policy_value", "market_value", "median_of_ratios", "median_policy_ratio"),
        F.count(F.lit(1)).alias("n_units"),
    ])
    overall = A.global_summary(m, [
        A.median_of("policy_value", "overall_median_policy"),
        ((F.sum("policy_value") - F.sum(p("policy_value"))) / F.nullif(F.sum(p("policy_value")), F.lit(0)))
        .alias("overall_policy_change"),
    ])
    return cross_scalar(seg, overall)


# ---------------------------------------------------------------- E19 / I29
@register("region_detail", UY + f"""
, summary AS (SELECT company FROM unit_year WHERE year = {CUR} GROUP BY company HAVING count(*) >= 30)
SELECT region, company, median(market_value) AS market_value_median, count(*) AS n
FROM unit_year WHERE year = {CUR} AND company IN (SELECT company FROM summary)
GROUP BY region, company""",
          digits={"market_value_median": MONEY}, ids=("I29", "E19", "D10"))
def q_region_detail(cat):
    f = cur_fact(cat)
    big = f.groupBy("company").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 30).select("company")
    return A.region_detail(f.join(big, ["company"], "left_semi"), ["region", "company"], ["market_value"])


# ---------------------------------------------------------------- E20
@register("box_stats", UY + f"""
, q AS (
  SELECT company, quantile_cont(market_value, 0.25) AS q1, median(market_value) AS median,
         quantile_cont(market_value, 0.75) AS q3, avg(market_value) AS mean, count(market_value) AS n
  FROM unit_year WHERE year = {CUR} GROUP BY company
)
SELECT q.company, q1, median, q3, mean, n,
       min(CASE WHEN market_value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN market_value END) AS whisker_low,
       max(CASE WHEN market_value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN market_value END) AS whisker_high,
       count(*) FILTER (WHERE NOT (market_value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM unit_year u JOIN q ON u.company = q.company
WHERE u.year = {CUR}
GROUP BY q.company, q1, median, q3, mean, n""",
          digits={"q1": MONEY, "median": MONEY, "q3": MONEY, "mean": MEAN, "whisker_low": MONEY, "whisker_high": MONEY},
          ids=("E20",))
def q_box_stats(cat):
    return A.box_stats(cur_fact(cat), ["company"], "market_value")


# ---------------------------------------------------------------- I21
@register("category_mix_yoy", UY + f"""
, c AS (SELECT unit_type, count(*) AS n_current, count(*) / sum(count(*)) OVER () AS share_current
        FROM unit_year WHERE year = {CUR} GROUP BY unit_type),
pr AS (SELECT unit_type, count(*) AS n_prior, count(*) / sum(count(*)) OVER () AS share_prior
        FROM unit_year WHERE year = {PREV} GROUP BY unit_type)
SELECT coalesce(c.unit_type, pr.unit_type) AS unit_type, n_current, share_current, n_prior, share_prior,
       coalesce(share_current, 0) - coalesce(share_prior, 0) AS share_change
FROM c FULL OUTER JOIN pr ON c.unit_type = pr.unit_type""",
          digits={"share_current": RATIO, "share_prior": RATIO, "share_change": RATIO}, ids=("I21", "F1", "D11"))
def q_category_mix_yoy(cat):
    return category_mix_yoy(fact(cat, [CUR, PREV]), "year", CUR, "unit_type")


# ---------------------------------------------------------------- I24
@register("scenario_share", UY + f"""
SELECT {_tot('unit_type')}, {_tot('region')},
       count(*) FILTER (WHERE own_input = 1) AS n_flagged, count(*) AS n,
       count(*) FILTER (WHERE own_input = 1) / nullif(count(*), 0) AS share
FROM unit_year WHERE year = {CUR}
GROUP BY GROUPING SETS ((unit_type, region), (unit_type), (region), ())""",
          digits={"share": RATIO}, ids=("I24", "E15", "G1"))
def q_scenario_share(cat):
    return scenario_share(cur_fact(cat), [], F.col("own_input") == 1, total_dims=["unit_type", "region"])


@register("scenario_share_yoy", UY + f"""
, s AS (SELECT unit_type, region, year, count(*) FILTER (WHERE own_input = 1) / nullif(count(*), 0) AS share
        FROM unit_year WHERE year IN ({CUR}, {PREV}) GROUP BY unit_type, region, year)
SELECT c.unit_type, c.region, c.share AS share_current, pr.share AS share_prior, c.share - pr.share AS share_change
FROM s c JOIN s pr ON c.unit_type = pr.unit_type AND c.region = pr.region AND c.year = {CUR} AND pr.year = {PREV}
""",
          digits={"share_current": RATIO, "share_prior": RATIO, "share_change": RATIO}, ids=("I24", "D12"))
def q_scenario_share_yoy(cat):
    return scenario_share_yoy(fact(cat, [CUR, PREV]), ["unit_type", "region"], "year", CUR, F.col("own_input") == 1)


# ---------------------------------------------------------------- I27 / G5
@register("trend_lines", UY + f"""
, med AS (SELECT year, valuation_type, median(market_value) AS m FROM unit_year
          WHERE year IN ({PREV}, {CUR}) GROUP BY year, valuation_type)
SELECT y.year, b.m AS median_basis, f.m AS median_full, b.m - f.m AS gap
FROM (SELECT DISTINCT year FROM med) y
LEFT JOIN med b ON b.year = y.year AND b.valuation_type = 'Basis'
LEFT JOIN med f ON f.year = y.year AND f.valuation_type = 'Full'""",
          digits={"median_basis": MONEY, "median_full": MONEY, "gap": MONEY}, ids=("I27", "G5", "E2"))
def q_trend_lines(cat):
    return trend_lines(fact(cat, [PREV, CUR]), "year", [PREV, CUR], "valuation_type", "market_value", "Basis", "Full")
