"""Bridge, waterfall, index and reshape queries: I11–I14, H3, H7, G4, F11, F12/A21."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import sql_pct_text
from ..operators.reshape import unpivot
from ..operators.sets import prefer_current
from ..operators.windows import pct_change, rank_label
from ..plans.bridge import cumulative_index, driver_bridge, waterfall, waterfall_by_company, waterfall_steps
from ..registry import register
from ..sources.standin import UNIT_YEAR_SQL, with_sql
from .common import CUR, INDEX, MEAN, MONEY, PREV, RATIO, STEPS, UY, fact, steps
from .merge_q import _YEARS
from .panel_q import VALUE_CHANGE_SQL, value_change_plan


# ---------------------------------------------------------------- I11 / H3 / F3–F6 / D16
def _bridge_inputs(cat, group: str | None):
    s = steps(cat).filter(F.col("year").isin(CUR, PREV))
    g = [] if group is None else [F.col(group).alias("grp")]
    gk = [] if group is None else ["grp"]
    eff = s.select(*g, "step", F.when(F.col("year") == CUR, F.col("value")).otherwise(-F.col("value")).alias("delta"))
    s = s.select(*g, "year", "value")
    base = s.filter(F.col("year") == PREV).groupBy(*gk).agg(F.sum("value").alias("base_value"))
    cur = F.sum(F.when(F.col("year") == CUR, F.col("value")))
    prev = F.sum(F.when(F.col("year") == PREV, F.col("value")))
    total = s.groupBy(*gk).agg(((cur - prev) / F.nullif(prev, F.lit(0))).alias("total_change"))
    return eff, base, total


def _bridge_sql(group_expr: str, top_n: int) -> str:
    """Oracle: one row per group and step with its effect and the group's total change (windows over
    the step sums); the remainder is the total less the shown effects."""
    return STEPS + f""",
sums AS (SELECT {group_expr} AS grp, step, coalesce(sum(value) FILTER (WHERE year = {CUR}), 0) AS now,
                coalesce(sum(value) FILTER (WHERE year = {PREV}), 0) AS before
         FROM line_steps WHERE year IN ({CUR}, {PREV}) GROUP BY ALL),
drivers AS (SELECT grp, step, (now - before) / nullif(sum(before) OVER g, 0) AS effect,
                   (sum(now) OVER g - sum(before) OVER g) / nullif(sum(before) OVER g, 0) AS whole
            FROM sums WINDOW g AS (PARTITION BY grp)),
shown AS (SELECT unnest(list(step ORDER BY abs(effect) DESC NULLS LAST, step)[1:{top_n}]) AS step FROM drivers GROUP BY grp),
placed AS (SELECT step, CAST(row_number() OVER (ORDER BY avg(abs(effect)) DESC NULLS LAST, step) AS INTEGER) AS step_order
           FROM drivers SEMI JOIN shown USING (step) GROUP BY step),
bars AS (
  SELECT grp, step, effect, step_order, sum(effect) OVER (PARTITION BY grp ORDER BY step_order) AS cumulative
  FROM drivers JOIN placed USING (step)
  UNION ALL
  SELECT grp, 'Other changes', any_value(whole) - sum(effect), (SELECT count(*) FROM placed)::INTEGER + 1, any_value(whole)
  FROM drivers SEMI JOIN placed USING (step) GROUP BY grp)
SELECT *, {sql_pct_text('effect')} AS effect_text, {sql_pct_text('cumulative')} AS cumulative_text FROM bars"""


@register("driver_bridge", _bridge_sql("region", 7), digits={"effect": RATIO, "cumulative": RATIO},
          ids=("I11", "H3", "F3", "F4", "F5", "F6", "D16", "E13"))
def q_driver_bridge(cat):
    eff, base, total = _bridge_inputs(cat, "region")
    return driver_bridge(eff, "grp", "step", "delta", base, "base_value", total, "total_change", 7)


@register("driver_bridge_single", _bridge_sql("'all'", 5), digits={"effect": RATIO, "cumulative": RATIO},
          ids=("I11",))
def q_driver_bridge_single(cat):
    eff, base, total = _bridge_inputs(cat, None)
    return driver_bridge(eff, None, "step", "delta", base, "base_value", total, "total_change", 5)


# ---------------------------------------------------------------- I12 / G1 / F10
WATERFALL_STEPS = [("market", "market_value"), ("gross", "gross_value"), ("discount", "discount_value"),
                   ("tax", "tax_value"), ("policy", "policy_value")]
WATERFALL_LISTED = ["low", "mid"]


def _waterfall_bar(i: int, label: str, column: str) -> str:
    measure = {1: "absolute", len(WATERFALL_STEPS): "total"}.get(i, "relative")
    share = f"avg({column}) / nullif(avg({WATERFALL_STEPS[0][1]}), 0)"
    return f"""SELECT coalesce(CASE WHEN grouping(unit_type) = 0 THEN unit_type END, 'Total') AS unit_type, '{label}' AS step, avg({column}) AS value,
       {share} AS percent, {sql_pct_text(share)} AS text, {i} AS step_order, '{measure}' AS measure
FROM valued GROUP BY ROLLUP (unit_type) HAVING grouping(unit_type) = 1 OR unit_type IN ({", ".join(f"'{c}'" for c in WATERFALL_LISTED)})"""


@register("waterfall", UY + f", valued AS (SELECT * FROM unit_year WHERE policy_value IS NOT NULL AND year = {CUR})\n" + "\nUNION ALL\n".join(
    _waterfall_bar(i, label, column) for i, (label, column) in enumerate(WATERFALL_STEPS, start=1)),
          digits={"value": MEAN, "percent": RATIO}, ids=("I12", "G1", "F10", "E8"))
def q_waterfall(cat):
    df = fact(cat, [CUR]).filter(F.col("policy_value").isNotNull())
    return waterfall(df, "unit_type", WATERFALL_LISTED, WATERFALL_STEPS)


# ---------------------------------------------------------------- I13 / C20
_WF_PARTS = ["gross_value", "discount_value", "tax_value"]


def _wf_company(cat):
    df = fact(cat, [CUR]).filter(F.col("policy_value").isNotNull())
    return waterfall_by_company(df, "company", "market_value", _WF_PARTS, "policy_value")


_WF_COMPANY_SQL = UY + f"""
, a AS (SELECT company, avg(market_value) AS market_value, {", ".join(f"avg({c}) AS {c}" for c in _WF_PARTS)},
               avg(policy_value) AS policy_value
        FROM unit_year WHERE year = {CUR} AND policy_value IS NOT NULL GROUP BY company),
wide AS (SELECT company, market_value, {", ".join(f"{c} / nullif(market_value, 0) AS {c}" for c in _WF_PARTS)}, policy_value FROM a)
"""


@register("waterfall_company", _WF_COMPANY_SQL + "SELECT * FROM wide",
          digits={"market_value": MEAN, "policy_value": MEAN, **{c: RATIO for c in _WF_PARTS}}, ids=("I13",))
def q_waterfall_company(cat):
    return _wf_company(cat)


def _exclusions(cat):
    # Exclusions are a table derived from the inputs (never literals): the
    # discount step is excluded for the companies of region 2.
    return cat["nation"].filter(F.col("n_regionkey") == 2).select(
        F.lit("discount_value").alias("step"), F.col("n_name").alias("company"))


@register("waterfall_steps", _WF_COMPANY_SQL + f"""
, ex AS (SELECT 'discount_value' AS step, lower(trim(n_name)) AS company FROM nation WHERE n_regionkey = 2),
long AS (SELECT company, v.step, v.value, v.step_order FROM wide CROSS JOIN LATERAL (VALUES
   {", ".join(f"('{c}', {c}, {i})" for i, c in enumerate(_WF_PARTS, start=1))}) AS v(step, value, step_order))
SELECT * FROM long l
WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.step = l.step AND ex.company = lower(trim(l.company)))""",
          digits={"value": RATIO}, ids=("I13", "C20", "G1"))
def q_waterfall_steps(cat):
    return waterfall_steps(_wf_company(cat), "company", _WF_PARTS, _exclusions(cat))


# ---------------------------------------------------------------- I14 / H7 / F7–F9 / F12
INDEX_BASES = (1997, 1999)


@register("cumulative_index", with_sql(UNIT_YEAR_SQL) + f"""
, mean AS (SELECT valuation_type, year, avg(market_value) AS v FROM unit_year GROUP BY ALL),
rates AS (
  SELECT coalesce(c.value_type, h.valuation_type) AS valuation_type, coalesce(c.year, h.year) AS year,
         CASE WHEN c.year IS NULL THEN h.rate ELSE c.rel_change END AS rate
  FROM (SELECT valuation_type, year, v / nullif(lag(v) OVER (PARTITION BY valuation_type ORDER BY year), 0) - 1 AS rate FROM mean) h
  FULL JOIN (SELECT value_type, year, rel_change FROM ({VALUE_CHANGE_SQL}) vc WHERE region = 'Total' AND value_kind = 'market') c
    ON c.value_type = h.valuation_type AND c.year = h.year
  WHERE coalesce(c.year, h.year) <= {CUR} OR c.year IS NOT NULL),
grown AS (SELECT *, 100 * product(1 + coalesce(rate, 0)) OVER (PARTITION BY valuation_type ORDER BY year) AS "index" FROM rates)
SELECT g.valuation_type, g.year, g.rate, 1 + g.rate AS index_change, g."index", {sql_pct_text('g.rate')} AS text,
       100 * g."index" / nullif(b."first", 0) AS index_base_first,
       {", ".join(f'100 * g."index" / nullif(b.base_{y}, 0) AS index_base_{y}' for y in INDEX_BASES)}
FROM grown g JOIN (SELECT valuation_type, arg_min("index", year) AS "first",
                          {", ".join(f'any_value("index") FILTER (WHERE year = {y}) AS base_{y}' for y in INDEX_BASES)}
                   FROM grown GROUP BY valuation_type) b ON b.valuation_type IS NOT DISTINCT FROM g.valuation_type""",
          digits={"rate": RATIO, "index_change": RATIO, "index": INDEX, "index_base_first": INDEX,
                  **{f"index_base_{b}": INDEX for b in INDEX_BASES}},
          ids=("I14", "H7", "F7", "F8", "F9", "F12", "H12"))
def q_cumulative_index(cat):
    cur = (value_change_plan(cat).filter((F.col("value_kind") == "market") & (F.col("region") == "Total"))
           .select(F.col("value_type").alias("valuation_type"), "year", F.col("rel_change").alias("rate")))
    yearly = fact(cat).groupBy("valuation_type", "year").agg(F.avg("market_value").alias("v"))
    hist = yearly.select("valuation_type", "year", pct_change("v", "year", ["valuation_type"]).alias("rate"))
    rates = prefer_current(cur, hist, ["valuation_type", "year"], "year", CUR)
    return cumulative_index(rates, "valuation_type", "year", "rate", INDEX_BASES)


# ---------------------------------------------------------------- G4
@register("yearly_unpivot", with_sql(UNIT_YEAR_SQL) + f"""
, yearly AS (SELECT o_custkey AS unit_id,
   {", ".join(f"sum(o_totalprice) FILTER (WHERE year(o_orderdate) = {y}) AS value_{y}" for y in _YEARS)}
   FROM orders WHERE year(o_orderdate) BETWEEN {_YEARS[0]} AND {_YEARS[-1]} GROUP BY o_custkey)
SELECT unit_id, CAST(substring(variable, 7, 4) AS INTEGER) AS year, value
FROM (UNPIVOT yearly ON {", ".join(f"value_{y}" for y in _YEARS)} INTO NAME variable VALUE value) u
WHERE value IS NOT NULL""", digits={"value": MONEY}, ids=("G4",))
def q_yearly_unpivot(cat):
    o = cat["orders"].select("o_custkey", F.year("o_orderdate").alias("y"), "o_totalprice")
    wide = (o.filter(F.col("y").between(_YEARS[0], _YEARS[-1])).groupBy(F.col("o_custkey").alias("unit_id"))
            .pivot("y", _YEARS).agg(F.sum("o_totalprice")))
    wide = wide.select("unit_id", *[F.col(str(y)).alias(f"value_{y}") for y in _YEARS])
    long = unpivot(wide, ["unit_id"], [f"value_{y}" for y in _YEARS], "variable", "value")
    return long.filter(F.col("value").isNotNull()).select(
        "unit_id", F.substring("variable", 7, 4).cast("int").alias("year"), "value")


# ---------------------------------------------------------------- F11
RANK_LABELS = ["lowest", "second", "third", "fourth", "highest"]


@register("rank_label", UY + f"""
, r AS (SELECT year, region, avg(discount_value / nullif(gross_value, 0)) AS discount_rate
        FROM unit_year GROUP BY year, region)
SELECT year, region, discount_rate,
       CASE row_number() OVER (PARTITION BY year ORDER BY discount_rate ASC NULLS LAST, region ASC NULLS LAST)
       {" ".join(f"WHEN {i} THEN '{lab}'" for i, lab in enumerate(RANK_LABELS, start=1))} END AS rank_label
FROM r""", digits={"discount_rate": RATIO}, ids=("F11",))
def q_rank_label(cat):
    r = fact(cat).groupBy("year", "region").agg(
        F.avg(F.col("discount_value") / F.nullif(F.col("gross_value"), F.lit(0))).alias("discount_rate"))
    return r.select("year", "region", "discount_rate",
                    rank_label("discount_rate", ["year"], RANK_LABELS, tie=["region"]).alias("rank_label"))


# ---------------------------------------------------------------- A21 / F12 / H14
@register("price_yoy", f"""
WITH m AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) || ' ' || strftime(o_orderdate, '%B') AS period,
         avg(o_totalprice) AS price_index
  FROM orders GROUP BY 1
), dec AS (
  SELECT CAST(regexp_extract(period, '(\\d{{4}})', 1) AS INTEGER) AS year, price_index FROM m
  WHERE contains(lower(period), 'december')
), yoy AS (
  SELECT year, price_index / nullif(lag(price_index) OVER (ORDER BY year), 0) - 1 AS yoy FROM dec
)
SELECT m.period, CAST(regexp_extract(m.period, '(\\d{{4}})', 1) AS INTEGER) AS year, m.price_index, yoy.yoy
FROM m LEFT JOIN yoy ON CAST(regexp_extract(m.period, '(\\d{{4}})', 1) AS INTEGER) = yoy.year""",
          digits={"price_index": MEAN, "yoy": RATIO}, ids=("A21", "F12", "H14"))
def q_price_yoy(cat):
    from ..sources.external import price_index_yoy

    o = cat["orders"]
    period = F.concat(F.year("o_orderdate").cast("string"), F.lit(" "), F.date_format("o_orderdate", "MMMM"))
    monthly = o.groupBy(period.alias("period")).agg(F.avg("o_totalprice").alias("price_index"))
    return price_index_yoy(monthly, "period", "price_index", "december")

