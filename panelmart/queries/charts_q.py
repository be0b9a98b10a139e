"""More chart models of the reference on the stand-in fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import fround, sql_fround, sql_pct_text
from ..functions.predicates import exclude
from ..operators import aggregates as A
from ..operators.joins import compare_years
from ..operators.reshape import to_long
from ..plans.panel import add_change_columns, matched
from ..registry import register
from .common import CUR, INDEX, MEAN, MONEY, NET, PREV, RATIO, UY, UY_PANEL, fact, p, panel

EXCLUDED_REGION_KEY = 4


def _exclusions(cat):
    """Companies excluded from some charts: a table derived from the inputs (never literals)."""
    return cat["nation"].filter(F.col("n_regionkey") == EXCLUDED_REGION_KEY).select(F.col("n_name").alias("company"))


_EXCL_SQL = f"SELECT n_name FROM nation WHERE n_regionkey = {EXCLUDED_REGION_KEY}"


# ---------------------------------------------------------------- E2 / D12 (median per company, current vs prior)
_MEDIANS = {y: f"median(market_value) FILTER (WHERE year = {y})" for y in (CUR, PREV)}


@register("median_by_company_yoy", UY + f"""
SELECT company, {_MEDIANS[CUR]} AS median_value, {_MEDIANS[PREV]} AS median_value_{PREV},
       {sql_fround(f"({_MEDIANS[CUR]} - {_MEDIANS[PREV]}) / nullif({_MEDIANS[PREV]}, 0)", 4)} AS median_growth
FROM unit_year WHERE model = 'Residential' AND unit_type IN ('low', 'mid')
GROUP BY company HAVING bool_or(year = {CUR}) AND bool_or(year = {PREV})""",
          digits={"median_value": MONEY, f"median_value_{PREV}": MONEY}, ids=("E2", "D12"))
def q_median_by_company_yoy(cat):
    f = fact(cat, [CUR, PREV]).filter(F.col("unit_type").isin("low", "mid")
                         & (F.col("model") == "Residential"))
    med = A.aggregate(f, ["year", "company"], [A.median_of("market_value", "median_value")])
    out = compare_years(med, ["company"], "year", CUR, PREV, ["median_value"])
    rel = (F.col("median_value") - F.col(f"median_value_{PREV}")) / F.nullif(F.col(f"median_value_{PREV}"), F.lit(0))
    return out.withColumn("median_growth", fround(rel, 4))


# ---------------------------------------------------------------- C21 / E1 / C12 (spread per company)
@register("spread_by_company", UY_PANEL + f"""
, paired AS (SELECT company, policy_value AS now, {p('policy_value')} AS before FROM panel
             ANTI JOIN (SELECT upper(trim(n_name)) AS n FROM nation WHERE n_regionkey = {EXCLUDED_REGION_KEY}) x ON x.n = upper(trim(company))
             WHERE _merge = 'both' AND policy_value + {p('policy_value')} IS NOT NULL),
company_sum AS (SELECT company, sum(now) AS now, sum(before) AS before, sum(now) - sum(before) AS gain FROM paired GROUP BY company)
SELECT company, now AS policy_value, before AS {p('policy_value')}, gain AS abs_change, gain / nullif(before, 0) AS rel_change,
       100 + 100 * gain / nullif(before, 0) AS index_change, {sql_pct_text("gain / nullif(before, 0)")} AS change_text
FROM company_sum""", digits={"policy_value": NET, p("policy_value"): NET, "abs_change": NET, "rel_change": RATIO,
                   "index_change": INDEX}, ids=("C21", "E1", "C12", "C13", "C14"))
def q_spread_by_company(cat):
    m = matched(panel(cat), pred=F.col("policy_value").isNotNull() & F.col(p("policy_value")).isNotNull())
    m = exclude(m, "company", _exclusions(cat))
    g = m.groupBy("company").agg(F.sum("policy_value").alias("policy_value"),
                                 F.sum(p("policy_value")).alias(p("policy_value")))
    return add_change_columns(g, "policy_value", p("policy_value"))


# ---------------------------------------------------------------- G2 / I9 / C12 (value change by region)
@register("region_value_change", UY_PANEL + f"""
, long AS (SELECT region, v.kind, v.cur, v.prev FROM panel CROSS JOIN LATERAL (VALUES
             ('market', market_value, {p('market_value')}), ('policy', policy_value, {p('policy_value')})) AS v(kind, cur, prev)
           WHERE _merge = 'both' AND v.cur IS NOT NULL AND v.prev IS NOT NULL),
g AS (SELECT kind, CASE WHEN grouping(region) = 1 THEN 'Total' ELSE region END AS region,
             avg(cur) AS value_current, avg(prev) AS value_prior, count(*) AS n_units
      FROM long GROUP BY GROUPING SETS ((kind, region), (kind)))
SELECT *, value_current - value_prior AS abs_change,
       (value_current - value_prior) / nullif(value_prior, 0) AS rel_change,
       (value_current - value_prior) / nullif(value_prior, 0) * 100 + 100 AS index_change,
       {sql_pct_text('(value_current - value_prior) / nullif(value_prior, 0)')} AS change_text
FROM g""", digits={"value_current": MEAN, "value_prior": MEAN, "abs_change": MEAN, "rel_change": RATIO,
                   "index_change": INDEX}, ids=("G2", "I9", "C12"))
def q_region_value_change(cat):
    m = matched(panel(cat))
    long = to_long(m, ["region"], [("market", F.col("market_value"), F.col(p("market_value"))),
                                   ("policy", F.col("policy_value"), F.col(p("policy_value")))], ["kind", "cur", "prev"])
    long = long.filter(F.col("cur").isNotNull() & F.col("prev").isNotNull())
    g = A.with_totals(long, ["kind"], ["region"], [F.avg("cur").alias("value_current"), F.avg("prev").alias("value_prior"),
                                                 F.count(F.lit(1)).alias("n_units")])
    return add_change_columns(g, "value_current", "value_prior")


# ---------------------------------------------------------------- I28 over two years / E9
@register("energy_share_yoy", UY + f"""
SELECT region,
       count(*) FILTER (WHERE year = {CUR} AND n_orders > 1) / nullif(count(*) FILTER (WHERE year = {CUR}), 0) AS share_current,
       count(*) FILTER (WHERE year = {PREV} AND n_orders > 1) / nullif(count(*) FILTER (WHERE year = {PREV}), 0) AS share_prior,
       count(*) FILTER (WHERE year = {CUR} AND n_orders > 1) / nullif(count(*) FILTER (WHERE year = {CUR}), 0)
       - count(*) FILTER (WHERE year = {PREV} AND n_orders > 1) / nullif(count(*) FILTER (WHERE year = {PREV}), 0) AS share_change
FROM unit_year WHERE year IN ({CUR}, {PREV}) GROUP BY region""",
          digits={"share_current": RATIO, "share_prior": RATIO, "share_change": RATIO}, ids=("I28", "E9", "E15"))
def q_energy_share_yoy(cat):
    f = fact(cat, [CUR, PREV])
    hit = F.col("n_orders") > 1

    def share(y):
        return A.count_where(hit & (F.col("year") == y)) / F.nullif(A.count_where(F.col("year") == y), F.lit(0))

    return f.groupBy("region").agg(share(CUR).alias("share_current"), share(PREV).alias("share_prior"),
                                   (share(CUR) - share(PREV)).alias("share_change"))


# ---------------------------------------------------------------- F6 (latest row per year)
@register("latest_per_year", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderdate AS last_date, o_orderkey AS last_order, o_totalprice AS last_value
FROM orders
QUALIFY row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
          digits={"last_value": MONEY}, ids=("F6",))
def q_latest_per_year(cat):
    from ..operators.windows import last_by

    o = cat["orders"].select(F.year("o_orderdate").alias("year"), F.col("o_orderdate").alias("last_date"),
                             F.col("o_orderkey").alias("last_order"), F.col("o_totalprice").alias("last_value"))
    return last_by(o, ["year"], ["last_date", "last_order"])


# ---------------------------------------------------------------- I9 (difference of means with total)
@register("basis_full_gap", UY + f"""
SELECT CASE WHEN grouping(region) = 1 THEN 'Total' ELSE region END AS region,
       avg(market_value) FILTER (WHERE valuation_type = 'Basis') AS mean_basis,
       avg(market_value) FILTER (WHERE valuation_type = 'Full') AS mean_full,
       avg(market_value) FILTER (WHERE valuation_type = 'Basis') - avg(market_value) FILTER (WHERE valuation_type = 'Full') AS gap
FROM unit_year WHERE year = {CUR} GROUP BY GROUPING SETS ((region), ())""",
          digits={"mean_basis": MEAN, "mean_full": MEAN, "gap": MEAN}, ids=("I9", "E9"))
def q_basis_full_gap(cat):
    b = A.avg_where("market_value", F.col("valuation_type") == "Basis")
    f = A.avg_where("market_value", F.col("valuation_type") == "Full")
    return A.grouping_sets(fact(cat, [CUR]), [["region"], []],
                           [b.alias("mean_basis"), f.alias("mean_full"), (b - f).alias("gap")])


# ---------------------------------------------------------------- C21 / G1 / E8 / E2 (medians with totals)
@register("median_value_excl", UY + f"""
, long AS (SELECT unit_type, v.kind, v.amount FROM unit_year
           CROSS JOIN LATERAL (VALUES ('market', market_value), ('policy', policy_value)) AS v(kind, amount)
           WHERE year = {CUR} AND lower(trim(company)) NOT IN (SELECT lower(trim(n_name)) FROM ({_EXCL_SQL}) x))
SELECT kind, CASE WHEN grouping(unit_type) = 1 THEN 'Total' ELSE unit_type END AS unit_type,
       median(amount) AS median_value, count(amount) AS n
FROM long GROUP BY GROUPING SETS ((kind, unit_type), (kind))""",
          digits={"median_value": NET}, ids=("C21", "G1", "E8", "E2"))
def q_median_value_excl(cat):
    f = exclude(fact(cat, [CUR]), "company", _exclusions(cat))
    long = to_long(f, ["unit_type"], [("market", F.col("market_value")), ("policy", F.col("policy_value"))], ["kind", "amount"])
    return A.with_totals(long, ["kind"], ["unit_type"], [A.median_of("amount", "median_value"), F.count("amount").alias("n")])


# ---------------------------------------------------------------- C3 / C5 (any-of flags -> class)
FLAG_COLS = ["valuation_type", "unit_type", "model"]
FLAG_HITS = ["Full", "high", "Other"]


@register("flag_class", UY + f"""
SELECT CASE WHEN {" OR ".join(f"coalesce({c} IN ({', '.join(repr(h) for h in FLAG_HITS)}), false)" for c in FLAG_COLS)}
            THEN 'override' ELSE 'standard' END AS flag_class,
       CASE WHEN complex = 'AUTOMOBILE' THEN 'AUTO' ELSE complex END AS complex_label,
       count(*) AS n_units
FROM unit_year WHERE year = {CUR} GROUP BY 1, 2""", ids=("C5", "C3"))
def q_flag_class(cat):
    from ..functions.columns import any_flag, relabel

    f = fact(cat, [CUR])
    cls = F.when(any_flag(FLAG_COLS, FLAG_HITS), F.lit("override")).otherwise(F.lit("standard"))
    return f.groupBy(cls.alias("flag_class"), relabel("complex", {"AUTOMOBILE": "AUTO"}).alias("complex_label")).agg(
        F.count(F.lit(1)).alias("n_units"))


# ---------------------------------------------------------------- E1 / H1 / C14 (usage per type, business order)
TYPE_ORDER = ["low", "mid", "high"]


@register("usage_by_type", UY + f"""
SELECT unit_type, type_order, n_units, share_full, {sql_pct_text('share_full')} AS share_text
FROM (SELECT unit_type,
             CASE {" ".join(f"WHEN unit_type = '{t}' THEN {i}" for i, t in enumerate(TYPE_ORDER, start=1))} END AS type_order,
             count(*) AS n_units, avg(CASE WHEN valuation_type = 'Full' THEN 1.0 ELSE 0.0 END) AS share_full
      FROM unit_year WHERE year = {CUR} GROUP BY unit_type) t
WHERE type_order IS NOT NULL""", digits={"share_full": RATIO}, ids=("E1", "H1", "C14"))
def q_usage_by_type(cat):
    from ..functions.columns import order_by_map, pct_text

    f = fact(cat, [CUR])
    g = f.groupBy("unit_type").agg(
        F.count(F.lit(1)).alias("n_units"),
        F.avg(F.when(F.col("valuation_type") == "Full", F.lit(1.0)).otherwise(F.lit(0.0))).alias("share_full"))
    g = g.withColumn("type_order", order_by_map("unit_type", TYPE_ORDER)).filter(F.col("type_order").isNotNull())
    return g.withColumn("share_text", pct_text("share_full"))


# ---------------------------------------------------------------- F1 / F2 / C14 (shares of a total)
@register("share_of_total", UY + f"""
, g AS (SELECT region, unit_type, sum(market_value) AS total_value FROM unit_year WHERE year = {CUR} GROUP BY region, unit_type)
SELECT region, unit_type, total_value,
       total_value / nullif((SELECT sum(total_value) FROM g), 0) AS share_total,
       total_value / nullif(sum(total_value) OVER (PARTITION BY region), 0) AS share_region,
       {sql_pct_text('total_value / nullif(sum(total_value) OVER (PARTITION BY region), 0)')} AS share_region_text
FROM g""", digits={"total_value": MONEY, "share_total": RATIO, "share_region": RATIO}, ids=("F1", "F2", "C14"))
def q_share_of_total(cat):
    from ..functions.columns import pct_text
    from ..operators.windows import share

    g = fact(cat, [CUR]).groupBy("region", "unit_type").agg(F.sum("market_value").alias("total_value"))
    out = share(share(g, "total_value", name="share_total"), "total_value", ["region"], name="share_region")
    return out.withColumn("share_region_text", pct_text("share_region"))


# ---------------------------------------------------------------- H7 (source precedence)
@register("source_precedence", UY_PANEL + f"""
, cur AS (SELECT valuation_type, year, avg(market_value) AS value, 'current' AS source
          FROM panel WHERE _merge = 'both' AND valuation_type = {p('valuation_type')} GROUP BY valuation_type, year),
hist AS (SELECT valuation_type, year, avg(market_value) AS value, 'history' AS source FROM unit_year GROUP BY valuation_type, year)
SELECT * FROM cur
UNION ALL
SELECT * FROM hist h WHERE year <= {CUR}
  AND NOT EXISTS (SELECT 1 FROM cur c WHERE c.valuation_type = h.valuation_type AND c.year = h.year)""",
          digits={"value": MEAN}, ids=("H7", "H4", "H6"))
def q_source_precedence(cat):
    from ..operators.sets import prefer_current

    m = matched(panel(cat), same=[("valuation_type", p("valuation_type"))])
    cur = m.groupBy("valuation_type", "year").agg(F.avg("market_value").alias("value")).withColumn("source", F.lit("current"))
    hist = fact(cat).groupBy("valuation_type", "year").agg(F.avg("market_value").alias("value")).withColumn(
        "source", F.lit("history"))
    return prefer_current(cur, hist, ["valuation_type", "year"], "year", CUR)


# ---------------------------------------------------------------- G5 (long -> wide by type, gap)
@register("pivot_gap", UY + f"""
, g AS (SELECT region, year, valuation_type, avg(market_value) AS v FROM unit_year
        WHERE year IN ({PREV}, {CUR}) GROUP BY region, year, valuation_type)
SELECT k.region, k.year, b.v AS Basis, f.v AS "Full", b.v - f.v AS gap
FROM (SELECT DISTINCT region, year FROM g) k
LEFT JOIN g b ON b.region = k.region AND b.year = k.year AND b.valuation_type = 'Basis'
LEFT JOIN g f ON f.region = k.region AND f.year = k.year AND f.valuation_type = 'Full'""",
          digits={"Basis": MEAN, "Full": MEAN, "gap": MEAN}, ids=("G5",))
def q_pivot_gap(cat):
    from ..operators.reshape import pivot_gap

    g = fact(cat, [PREV, CUR]).groupBy("region", "year", "valuation_type").agg(F.avg("market_value").alias("v"))
    return pivot_gap(g, ["region", "year"], "valuation_type", "v", "Basis", "Full")


# ---------------------------------------------------------------- E8 / I28 (native grouping sets, share)
@register("grouping_sets_share", UY + f"""
SELECT CASE WHEN grouping(region) = 1 THEN 'Total' ELSE region END AS region,
       CASE WHEN grouping(valuation_type) = 1 THEN 'Total' ELSE valuation_type END AS valuation_type,
       count(*) FILTER (WHERE own_input = 1) / count(*) AS share_own_input, count(*) AS n
FROM unit_year WHERE year = {CUR}
GROUP BY GROUPING SETS ((region, valuation_type), (region), ())""",
          digits={"share_own_input": RATIO}, ids=("E8", "I28", "E9"))
def q_grouping_sets_share(cat):
    return A.grouping_sets(fact(cat, [CUR]), [["region", "valuation_type"], ["region"], []], [
        (A.count_where(F.col("own_input") == 1) / F.count(F.lit(1))).alias("share_own_input"),
        F.count(F.lit(1)).alias("n")])
