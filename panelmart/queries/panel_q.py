"""Panel queries: I5, I15 (flagship), I10, I21, I24, I25, I27, E3/E4."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import sql_pct_text
from ..plans.panel import matched, value_change
from ..registry import register
from .common import CUR, INDEX, MEAN, MONEY, NET, RATIO, TAX, UY, UY_PANEL, fact, p, panel

_KIND = {"market_value": MONEY, "gross_value": MONEY, "acctbal": MONEY, "policy_value": NET,
         "discount_value": NET, "tax_value": TAX, "pct_full": RATIO}
_PANEL_DIGITS = {**_KIND, **{p(c): d for c, d in _KIND.items() if c in
                             ("market_value", "policy_value", "discount_value", "pct_full", "tax_value", "acctbal")}}


@register("yoy_panel", UY_PANEL + "SELECT * FROM panel",
          digits=_PANEL_DIGITS,
          ids=("I5", "D4", "D1", "A1", "A2", "A25"))
def q_yoy_panel(cat):
    return panel(cat)


# ---------------------------------------------------------------- I15 flagship
VALUE_SPECS = [
    ("market", "valuation_type", "market_value", p("market_value"), True),
    ("policy", "policy", "policy_value", p("policy_value"), False),
    ("policy_split", "valuation_type", "policy_value", p("policy_value"), True),
]
_CHANGE_DIGITS = {"value_current": MEAN, "value_prior": MEAN, "abs_change": MEAN, "rel_change": RATIO, "index_change": INDEX}


def value_change_plan(cat):
    m = matched(panel(cat), same=[("model", p("model"))], pred=F.col("model") == F.lit("Residential"))
    return value_change(m, VALUE_SPECS, "valuation_type", p("valuation_type"), "year", "unit_id",
                        by=["region"], totals=True)


VALUE_CHANGE_SQL = UY_PANEL + f""",
m AS (
    SELECT * FROM panel
    WHERE _merge = 'both' AND model = {p('model')} AND model = 'Residential'
),
long AS (
    SELECT unit_id, year, region, valuation_type, {p('valuation_type')} AS type_prior,
           v.value_kind, v.value_type, v.value_current, v.value_prior, v.same_type
    FROM m CROSS JOIN LATERAL (VALUES
        ('market', valuation_type, market_value, {p('market_value')}, true),
        ('policy', 'policy', policy_value, {p('policy_value')}, false),
        ('policy_split', valuation_type, policy_value, {p('policy_value')}, true)
    ) AS v(value_kind, value_type, value_current, value_prior, same_type)
    WHERE v.value_current IS NOT NULL AND v.value_prior IS NOT NULL
      AND (NOT v.same_type OR valuation_type = type_prior)
),
g AS (
    SELECT value_kind, value_type, year,
           CASE WHEN grouping(region) = 1 THEN 'Total' ELSE region END AS region,
           avg(value_current) AS value_current, avg(value_prior) AS value_prior,
           count(unit_id) AS n_units
    FROM long
    GROUP BY GROUPING SETS ((value_kind, value_type, year, region), (value_kind, value_type, year))
)
SELECT *, value_current - value_prior AS abs_change,
       (value_current - value_prior) / nullif(value_prior, 0) AS rel_change,
       (value_current - value_prior) / nullif(value_prior, 0) * 100 + 100 AS index_change,
       {sql_pct_text('(value_current - value_prior) / nullif(value_prior, 0)')} AS change_text
FROM g"""


@register("value_change", VALUE_CHANGE_SQL, digits=_CHANGE_DIGITS, ids=("I15", "I9", "G1", "G2", "C12", "C13", "C14"))
def q_value_change(cat):
    return value_change_plan(cat)


# ---------------------------------------------------------------- C3 / C12 (current non-zero) / C13 / C14 / H1
TYPE_LABELS = {"negative": "debt", "high": "upper"}
TYPE_ORDER = ["debt", "low", "mid", "upper"]
EXCLUDED_LABEL = "low"


def _relabel_sql(c: str) -> str:
    whens = " ".join(f"WHEN {c} = '{a}' THEN '{b}'" for a, b in TYPE_LABELS.items())
    return f"CASE {whens} ELSE {c} END"


@register("model_change", UY_PANEL + f"""
, base AS (
  SELECT {_relabel_sql('unit_type')} AS type_label, {_relabel_sql(p('unit_type'))} AS type_label_prior,
         market_value, {p('market_value')} AS market_value_prior, unit_id
  FROM panel
), g AS (
  SELECT type_label, avg(market_value) AS market_value, avg(market_value_prior) AS {p('market_value')},
         count(unit_id) AS n_units
  FROM base
  WHERE type_label = type_label_prior AND type_label <> '{EXCLUDED_LABEL}'
    AND market_value IS NOT NULL AND market_value_prior IS NOT NULL
  GROUP BY type_label
)
SELECT type_label, market_value, {p('market_value')}, n_units,
       market_value - {p('market_value')} AS abs_change,
       CASE WHEN market_value != 0 THEN (market_value - {p('market_value')}) / nullif({p('market_value')}, 0) END AS rel_change,
       CASE WHEN market_value != 0 THEN (market_value - {p('market_value')}) / nullif({p('market_value')}, 0) END * 100 + 100 AS index_change,
       {sql_pct_text(f"CASE WHEN market_value != 0 THEN (market_value - {p('market_value')}) / nullif({p('market_value')}, 0) END")} AS change_text,
       CASE {" ".join(f"WHEN type_label = '{v}' THEN {i}" for i, v in enumerate(TYPE_ORDER, start=1))} END AS type_order
FROM g""", digits={"market_value": MEAN, p("market_value"): MEAN, "abs_change": MEAN, "rel_change": RATIO,
                   "index_change": INDEX}, ids=("C3", "C12", "C13", "C14", "H1", "H9"))
def q_model_change(cat):
    from ..functions.columns import abs_change, as_index, order_by_map, pct_text, rel_change, relabel

    pn = panel(cat).select(relabel("unit_type", TYPE_LABELS).alias("type_label"),
                           relabel(p("unit_type"), TYPE_LABELS).alias("type_label_prior"),
                           "market_value", F.col(p("market_value")).alias("market_value_prior"), "unit_id")
    base = pn.filter((F.col("type_label") == F.col("type_label_prior")) & (F.col("type_label") != EXCLUDED_LABEL)
                     & F.col("market_value").isNotNull() & F.col("market_value_prior").isNotNull())
    g = base.groupBy("type_label").agg(F.avg("market_value").alias("market_value"),
                                       F.avg("market_value_prior").alias(p("market_value")),
                                       F.count("unit_id").alias("n_units"))
    rel = rel_change("market_value", p("market_value"), require_current_nonzero=True)
    return g.select("*", abs_change("market_value", p("market_value")).alias("abs_change"), rel.alias("rel_change"),
                    as_index(rel).alias("index_change"), pct_text(rel).alias("change_text"),
                    order_by_map("type_label", TYPE_ORDER).alias("type_order"))


# ---------------------------------------------------------------- G1 / F2 / C14
@register("share_per_model", UY + f"""
, long AS (
  SELECT year, {_relabel_sql('unit_type')} AS type_label, v.value_kind, v.amount
  FROM unit_year CROSS JOIN LATERAL (VALUES ('market', market_value), ('policy', policy_value)) AS v(value_kind, amount)
  WHERE year = {CUR} AND v.amount IS NOT NULL
), g AS (
  SELECT value_kind, year, type_label,
         {"CAST(floor(sum(amount) / nullif(sum(sum(amount)) OVER (PARTITION BY value_kind, year), 0) * 1000.0 + 0.5) / 1000.0 AS DOUBLE)"} AS share
  FROM long GROUP BY value_kind, year, type_label
)
SELECT *, {sql_pct_text('share')} AS text FROM g""", ids=("G1", "F2", "C14", "C3"))
def q_share_per_model(cat):
    from ..functions.columns import fround, pct_text, relabel
    from ..operators.reshape import to_long
    from ..operators.windows import share

    f = fact(cat, [CUR]).withColumn("type_label", relabel("unit_type", TYPE_LABELS))
    long = to_long(f, ["year", "type_label"], [("market", F.col("market_value")), ("policy", F.col("policy_value"))],
                   ["value_kind", "amount"]).filter(F.col("amount").isNotNull())
    g = long.groupBy("value_kind", "year", "type_label").agg(F.sum("amount").alias("amount"))
    s = share(g, "amount", ["value_kind", "year"], name="share_raw")
    return s.select("value_kind", "year", "type_label", fround("share_raw", 3).alias("share")).withColumn(
        "text", pct_text("share"))


# ---------------------------------------------------------------- C4 / C11 / C23 / H8
KEEP_COMPANIES = ["NATION_1", "NATION_2", "NATION_3"]
RENAME_AREAS = {"NATION_1": "N-one"}
EXCLUDE_IN_CURRENT_YEAR = "nation_0"
CORRECTION_TERMS = {"Full": ("discount_value", "tax_value"), "Basis": ("tax_value", "discount_value")}


@register("area_values", UY + f"""
SELECT CASE WHEN company IN ({", ".join(f"'{c}'" for c in KEEP_COMPANIES)})
            THEN (CASE {" ".join(f"WHEN company = '{a}' THEN '{b}'" for a, b in RENAME_AREAS.items())} ELSE company END)
            ELSE region END AS area,
       avg(CASE {" ".join(f"WHEN own_input = 1 AND valuation_type = '{s}' THEN market_value - {r} + coalesce({a}, 0.0)" for s, (r, a) in CORRECTION_TERMS.items())}
                ELSE market_value END) AS corrected_value,
       count(*) AS n_units
FROM unit_year
WHERE year = {CUR} {f"AND lower(trim(company)) NOT IN ('{EXCLUDE_IN_CURRENT_YEAR}')" if CUR == 2000 else ""}
GROUP BY 1""", digits={"corrected_value": MEAN}, ids=("C4", "C11", "C23", "H8"))
def q_area_values(cat):
    from ..functions.columns import area_label, corrected, norm_text

    f = fact(cat, [CUR])
    if CUR == 2000:  # C23: a predicate compiled into the plan for one year only
        f = f.filter(~norm_text("company").isin(EXCLUDE_IN_CURRENT_YEAR))
    f = f.withColumn("own_flag", F.col("own_input").cast("string"))
    val = corrected("market_value", "own_flag", "1", "valuation_type", CORRECTION_TERMS)
    return f.groupBy(area_label("company", "region", KEEP_COMPANIES, RENAME_AREAS).alias("area")).agg(
        F.avg(val).alias("corrected_value"), F.count(F.lit(1)).alias("n_units"))
