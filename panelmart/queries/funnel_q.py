"""Funnel, buckets and override queries: I1, I6–I8, I16–I20, I22, I23, I30, C15, D15."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import funnel as FN
from ..plans import overrides as OV
from ..registry import register
from .common import CUR, MEAN, MONEY, PREV, RATIO, UY, UY_PANEL, fact, p, panel

# ---------------------------------------------------------------- I6 / I7
FUNNEL_LABELS = ["start", "company full share", "no busy complexes", "no excluded regions",
                 "no flagged large values", "min units"]
EXCLUDED_REGIONS = ["AFRICA"]
FULL_SHARE_MIN, MIN_UNITS = 0.3, 20


def funnel_steps():
    flagged = (F.col("own_input") == 1) & ((F.col("tax_value") > 30000) | (F.col("discount_value") > 60000)
                                           | (F.col("n_lines") > 20))
    return [
        FN.GroupMean(FUNNEL_LABELS[1], ["company"], "pct_full", FULL_SHARE_MIN),
        FN.ExcludeGroups(FUNNEL_LABELS[2], ["company", "complex"], F.col("n_orders") >= 4),
        FN.ExcludeGroups(FUNNEL_LABELS[3], ["company", "complex"], F.col("region").isin(EXCLUDED_REGIONS)),
        FN.RowFilter(FUNNEL_LABELS[4], ~flagged),
        FN.GroupCount(FUNNEL_LABELS[5], ["company"], MIN_UNITS),
    ]


def funnel_annotated(cat):
    def build(c):
        base = fact(c, [CUR]).filter(F.col("model") == "Residential")
        return FN.validation_funnel(base, funnel_steps())
    return cat.model("funnel", build)


_REGIONS_SQL = ", ".join(f"'{r}'" for r in EXCLUDED_REGIONS)
# Oracle: one row per unit with the number of steps it survives.  Company and complex
# facts are window aggregates over the base rows (a company or complex passes or fails
# as a whole, so they hold at any later step too); only the last step counts survivors.
FUNNEL_CTES = UY + f"""
, judged AS (
  SELECT *,
         coalesce(avg(pct_full) OVER (PARTITION BY company) > {FULL_SHARE_MIN}, false) AS full_enough,
         complex IS NULL OR NOT coalesce(bool_or(n_orders >= 4) OVER (PARTITION BY company, complex), false) AS calm,
         complex IS NULL OR NOT coalesce(bool_or(region IN ({_REGIONS_SQL})) OVER (PARTITION BY company, complex), false) AS inside,
         NOT (own_input = 1 AND greatest(tax_value / 30000, discount_value / 60000, n_lines / 20) > 1) AS plain_input
  FROM unit_year WHERE year = {CUR} AND model = 'Residential'),
funnel AS (
  SELECT * EXCLUDE (survivors), CASE WHEN passed = 4 AND survivors > {MIN_UNITS} THEN 5 ELSE passed END AS reached
  FROM (SELECT *, count(*) FILTER (WHERE passed = 4) OVER (PARTITION BY company) AS survivors
        FROM (SELECT *, CASE WHEN NOT full_enough THEN 0 WHEN NOT calm THEN 1 WHEN NOT inside THEN 2
                             WHEN plain_input IS NOT TRUE THEN 3 ELSE 4 END AS passed FROM judged) j) k)
"""


def stage_sql(step: int) -> str:
    """Units that survive ``step`` steps of the oracle's funnel."""
    return f"(SELECT * FROM funnel WHERE reached >= {step})"


@register("funnel", FUNNEL_CTES + "SELECT unit_id, company, complex, unit_type, market_value FROM funnel WHERE reached = 5",
          digits={"market_value": MONEY}, ids=("I6", "D8", "D10", "E12"))
def q_funnel(cat):
    return FN.funnel_result(funnel_annotated(cat), len(FUNNEL_LABELS) - 1).select(
        "unit_id", "company", "complex", "unit_type", "market_value")


@register("funnel_stats", FUNNEL_CTES + "\n" + "\nUNION ALL\n".join(
    f"""SELECT '{lab}' AS step, {i} AS step_no, count(DISTINCT company) AS n_companies,
       count(DISTINCT company || complex) AS n_sub_companies,
       count(DISTINCT company || complex || unit_type) AS n_complexes, count(*) AS n_units,
       CAST(floor(sum(market_value) / 1e9 * 10.0 + 0.5) / 10.0 AS DOUBLE) AS value_bn
FROM {stage_sql(i)} st""" for i, lab in enumerate(FUNNEL_LABELS)),
          ids=("I7", "E11", "K12"))
def q_funnel_stats(cat):
    return FN.funnel_stats(funnel_annotated(cat), FUNNEL_LABELS, "company", "complex", "unit_type", "market_value")


# ---------------------------------------------------------------- I8 / C15 / D15 / F1
BUCKET_EDGES = [round(-0.25 + 0.05 * i, 2) for i in range(11)]


def _bucket_label(i: int) -> str:
    if i == 0:
        return f"< {int(BUCKET_EDGES[0] * 100)}%"
    if i == len(BUCKET_EDGES):
        return f">= {int(BUCKET_EDGES[-1] * 100)}%"
    return f"{int(round(BUCKET_EDGES[i - 1] * 100))}% to {int(round(BUCKET_EDGES[i] * 100))}%"


BUCKET_LABELS = [_bucket_label(i) for i in range(len(BUCKET_EDGES) + 1)]


def _company_growth(cat):
    f = fact(cat, [CUR, PREV])
    cur = F.sum(F.when(F.col("year") == CUR, F.col("market_value")))
    prev = F.sum(F.when(F.col("year") == PREV, F.col("market_value")))
    return f.groupBy("company").agg((cur / F.nullif(prev, F.lit(0)) - F.lit(1)).alias("deviation"),
                                    F.count(F.when(F.col("year") == CUR, F.lit(1))).alias("n_units"))


def _bucket_case(expr: str) -> str:
    whens = " ".join(f"WHEN {expr} < {e} THEN '{lab}'" for e, lab in zip(BUCKET_EDGES, BUCKET_LABELS))
    return f"CASE {whens} ELSE '{BUCKET_LABELS[-1]}' END"


@register("bucket_complete", UY + f"""
, dev AS (
  SELECT company,
         sum(market_value) FILTER (WHERE year = {CUR}) / nullif(sum(market_value) FILTER (WHERE year = {PREV}), 0) - 1 AS deviation,
         count(*) FILTER (WHERE year = {CUR}) AS n_units
  FROM unit_year WHERE year IN ({CUR}, {PREV}) GROUP BY company
), b AS (SELECT {_bucket_case('deviation')} AS bucket, n_units FROM dev),
agg AS (SELECT bucket, count(*) AS n_groups, sum(n_units) AS n_units FROM b GROUP BY bucket),
domain AS (SELECT * FROM (VALUES {", ".join(f"('{lab}', {i})" for i, lab in enumerate(BUCKET_LABELS, start=1))}) AS d(bucket, bucket_order))
SELECT d.bucket, d.bucket_order, coalesce(agg.n_groups, 0) AS n_groups, CAST(coalesce(agg.n_units, 0) AS BIGINT) AS n_units,
       coalesce(agg.n_groups, 0) / nullif((SELECT count(*) FROM dev), 0) AS share_groups,
       coalesce(agg.n_units, 0) / nullif((SELECT sum(n_units) FROM dev), 0) AS share_units
FROM domain d LEFT JOIN agg ON d.bucket = agg.bucket""",
          digits={"share_groups": RATIO, "share_units": RATIO}, ids=("I8", "C15", "D15", "F1"))
def q_bucket_complete(cat):
    domain = cat.spark.createDataFrame([(lab, i) for i, lab in enumerate(BUCKET_LABELS, start=1)],
                                       "bucket string, bucket_order int")
    return FN.deviation_buckets(_company_growth(cat), "deviation", "n_units", BUCKET_EDGES, BUCKET_LABELS, domain)


# ---------------------------------------------------------------- I1 / C6
@register("override_class", UY_PANEL + f"""
SELECT unit_id, company,
       (CASE WHEN valuation_type IN ('Full') THEN 1 ELSE 0 END) + (CASE WHEN {p('valuation_type')} IN ('Full') THEN 1 ELSE 0 END) AS n_full_hits,
       (CASE WHEN unit_type IN ('high') THEN 1 ELSE 0 END) + (CASE WHEN {p('unit_type')} IN ('high') THEN 1 ELSE 0 END) AS n_free_hits,
       CASE WHEN n_full_hits > 0 THEN 1 ELSE 0 END AS pct_full_flag,
       CASE WHEN n_free_hits > 0 THEN 1 ELSE 0 END AS free_flag,
       CASE WHEN n_free_hits > 0 THEN 'free' WHEN n_full_hits > 0 THEN 'full' ELSE 'basis' END AS override_class
FROM panel""", ids=("I1", "C6", "C5"))
def q_override_class(cat):
    pn = panel(cat).select("unit_id", "company", "valuation_type", p("valuation_type"), "unit_type", p("unit_type"))
    out = FN.override_class(pn, ["valuation_type", p("valuation_type")], ["unit_type", p("unit_type")], ["Full", "high"])
    return out.drop("valuation_type", p("valuation_type"), "unit_type", p("unit_type"))


# ---------------------------------------------------------------- I16–I18 configs
def _configs(b_full: bool):
    flag = ("own_input", p("own_input"))
    scen = ("valuation_type", "unit_type", p("valuation_type"), p("unit_type"))
    return [
        OV.OverrideConfig("tax_abs", "tax_value", p("tax_value"), "discount_value", p("discount_value"), "abs",
                          use_flag=flag, own_value=1 if b_full else None, scenario=(*scen, "high"),
                          scenario_source_value="Full"),
        OV.OverrideConfig("rate_rel", "pct_full", p("pct_full"), None, None, "rel", rate=True),
        OV.OverrideConfig("market_rel", "market_value", p("market_value"), "policy_value", p("policy_value"), "rel",
                          use_flag=flag, own_value=1 if b_full else None, scenario=(*scen, "low"),
                          scenario_source_value="Full"),
    ]


def _exclusion_table(cat):
    # The outlier list is a table derived from the inputs (measure, company, year).
    return cat["nation"].filter(F.col("n_regionkey") == 3).select(
        F.lit("market_value").alias("measure"), F.col("n_name").alias("company"), F.lit(CUR).alias("year"))


def _prepared(cat, b_full):
    m = panel(cat).filter(F.col("_merge") == "both")
    return OV.with_exclusions(m, "company", _exclusion_table(cat), [c for c in _configs(b_full) if c.name == "market_rel"],
                              cur_year=CUR)


def _cfg_sql(cfg: OV.OverrideConfig) -> str:
    parts = ["1=1"]
    if cfg.use_flag:
        a, b = cfg.use_flag
        parts.append(f"{a} = {b}")
        if cfg.own_value is not None:
            parts.append(f"{a} = {cfg.own_value} AND {b} = {cfg.own_value}")
    if cfg.scenario:
        src, code, src_p, code_p, ex = cfg.scenario
        sv = cfg.scenario_source_value
        parts.append(f"NOT ({src} = '{sv}' AND {code} = '{ex}')")
        parts.append(f"NOT ({src_p} = '{sv}' AND {code_p} = '{ex}')")
    if cfg.rate:
        cols = [cfg.value, cfg.prior] + ([cfg.basic, cfg.basic_prior] if cfg.basic else [])
        parts += [f"({c} IS NULL OR {c} <= 1.0)" for c in cols]
    if cfg.name == "market_rel":
        parts.append(f"company NOT IN (SELECT company FROM ex WHERE measure = '{cfg.value}' AND year = {CUR})")
    return " AND ".join(parts)


def _chg(c: str, pr: str, diff: str) -> str:
    return f"{c} - {pr}" if diff == "abs" else f"({c} - {pr}) / nullif({pr}, 0)"


_PREP_SQL = UY_PANEL + f"""
, ex AS (SELECT 'market_value' AS measure, n_name AS company, {CUR} AS year FROM nation WHERE n_regionkey = 3),
prep AS (SELECT * FROM panel WHERE _merge = 'both')
"""


LABELS = ("Basis", "Full", "Full (handbook)")


def _labelled(cfg, by: str) -> str:
    """Rows (by, label, now, before): each unit under its valuation type, full ones once more with the handbook's value."""
    b, h = cfg.basic or cfg.value, cfg.basic_prior or cfg.prior
    return f"""(SELECT {by}, valuation_type AS label, {cfg.value} AS now, {cfg.prior} AS before FROM prep
               WHERE valuation_type IN ('Basis', 'Full') AND {_cfg_sql(cfg)}
               UNION ALL BY NAME
               SELECT {by}, '{LABELS[2]}' AS label, {b} AS now, {h} AS before FROM prep WHERE valuation_type = 'Full' AND {_cfg_sql(cfg)})"""


def _i16_arm(cfg) -> str:
    """Every region that has units at all shows every label, with NULL where it has none of that kind."""
    return f"""SELECT '{cfg.name}' AS config, spine.region, spine.label AS valuation_type, {_chg('avg(now)', 'avg(before)', cfg.diff)} AS value
FROM (SELECT DISTINCT region, unnest({list(LABELS)!r}) AS label FROM prep WHERE {_cfg_sql(cfg)}) spine
LEFT JOIN {_labelled(cfg, 'region')} u ON u.region IS NOT DISTINCT FROM spine.region AND u.label = spine.label
GROUP BY spine.region, spine.label"""


@register("override_change", _PREP_SQL + "\nUNION ALL\n".join(_i16_arm(c) for c in _configs(False)),
          digits={"value": MEAN}, ids=("I16", "G3", "G6", "E10", "C17", "C18", "C19", "D9", "R7"))
def q_override_change(cat):
    return OV.override_change(_prepared(cat, False), "region", "valuation_type", _configs(False))


def _i17_arm(cfg) -> str:
    kinds = {"level": f"avg({cfg.value})", "change": _chg(f"avg({cfg.value})", f"avg({cfg.prior})", cfg.diff)}
    return "\nUNION ALL\n".join(
        f"SELECT '{cfg.name}' AS config, company, valuation_type, '{kind}' AS calc_type, {value} AS value\n"
        f"FROM prep WHERE {_cfg_sql(cfg)} GROUP BY company, valuation_type" for kind, value in kinds.items()) + (f"""
UNION ALL
SELECT '{cfg.name}', company, '{LABELS[2]}', 'level', avg({cfg.basic}) FROM prep WHERE {_cfg_sql(cfg)} GROUP BY company""" if cfg.basic else "")


@register("override_level", _PREP_SQL + "\nUNION ALL\n".join(_i17_arm(c) for c in _configs(True)),
          digits={"value": MEAN}, ids=("I17", "G3", "G6"))
def q_override_level(cat):
    return OV.override_level_and_change(_prepared(cat, True), "company", "valuation_type", _configs(True))


def _i18_arm(cfg) -> str:
    kinds = {"current": "avg(now)", "prior": "avg(before)", "Difference": _chg("avg(now)", "avg(before)", cfg.diff)}
    return "\nUNION ALL\n".join(
        f"SELECT '{cfg.name}' AS config, company, label AS valuation_type, '{kind}' AS measure, {value} AS value\n"
        f"FROM {_labelled(cfg, 'company')} u GROUP BY company, label" for kind, value in kinds.items())


@register("override_box", _PREP_SQL + "\nUNION ALL\n".join(_i18_arm(c) for c in _configs(False)),
          digits={"value": MEAN}, ids=("I18", "E9", "G3"))
def q_override_box(cat):
    return OV.override_box(_prepared(cat, False), "company", "valuation_type", _configs(False))


# ---------------------------------------------------------------- I19
USAGE_FLAGS_SQL = [("own_input", "own_input = 1"), ("full_valued", "valuation_type = 'Full'"), ("multi_order", "n_orders > 1")]


@register("override_usage", UY + f"""
, g AS (SELECT CASE WHEN grouping(unit_type) = 1 THEN 'Total' ELSE unit_type END AS unit_type, count(*) AS n,
       {", ".join(f"avg(CASE WHEN {cond} THEN 1.0 ELSE 0.0 END) AS s{i}" for i, (_, cond) in enumerate(USAGE_FLAGS_SQL))}
  FROM unit_year WHERE year = {CUR} GROUP BY GROUPING SETS ((unit_type), ()))
SELECT unit_type, n, v.override, v.share_own_input FROM g CROSS JOIN LATERAL (VALUES
  {", ".join(f"('{name}', s{i})" for i, (name, _) in enumerate(USAGE_FLAGS_SQL))}) AS v(override, share_own_input)""",
          digits={"share_own_input": RATIO}, ids=("I19", "G1", "E10"))
def q_override_usage(cat):
    flags = [("own_input", F.col("own_input") == 1), ("full_valued", F.col("valuation_type") == "Full"),
             ("multi_order", F.col("n_orders") > 1)]
    return OV.override_usage(fact(cat, [CUR]), "unit_type", flags)


# ---------------------------------------------------------------- I20 / D13 / C22 / C24
REALISED_RANGE = (-0.5, 0.5)


@register("realised_expected", UY + f"""
, cur AS (SELECT unit_id, company, market_value FROM unit_year WHERE year = {CUR}),
prev AS (SELECT unit_id, company, market_value AS prev_value FROM unit_year WHERE year = {PREV}),
params AS (SELECT a.unit_id, a.company, (a.market_value - b.market_value) / nullif(b.market_value, 0) AS expected
           FROM unit_year a JOIN unit_year b ON a.unit_id = b.unit_id AND a.company = b.company
           WHERE a.year = {PREV} AND b.year = {PREV - 1}),
j AS (SELECT unit_id, cur.company, (market_value - prev_value) / nullif(prev_value, 0) AS measured, expected
      FROM cur JOIN prev USING (unit_id, company) JOIN params USING (unit_id, company))
SELECT company, median(measured - expected) AS median_deviation, avg(measured - expected) AS mean_deviation,
       count(*) AS n_units,
       avg(CASE WHEN {"CAST(floor(measured * 100.0 + 0.5) / 100.0 AS DOUBLE)"} = {"CAST(floor(expected * 100.0 + 0.5) / 100.0 AS DOUBLE)"} THEN 1.0 ELSE 0.0 END) AS share_equal,
       count(*) FILTER (WHERE measured BETWEEN {REALISED_RANGE[0]} AND {REALISED_RANGE[1]}) AS n_within,
       count(*) FILTER (WHERE measured < {REALISED_RANGE[0]} OR measured > {REALISED_RANGE[1]}) AS n_outside,
       median((measured - expected) / nullif(expected, 0)) AS median_rel_error,
       median(measured - expected) FILTER (WHERE measured BETWEEN {REALISED_RANGE[0]} AND {REALISED_RANGE[1]}) AS median_within,
       avg(measured - expected) FILTER (WHERE measured BETWEEN {REALISED_RANGE[0]} AND {REALISED_RANGE[1]}) AS mean_within,
       count(*) FILTER (WHERE NOT measured BETWEEN {REALISED_RANGE[0]} AND {REALISED_RANGE[1]} AND unit_id % 2 = 0)
         / nullif(count(*) FILTER (WHERE NOT measured BETWEEN {REALISED_RANGE[0]} AND {REALISED_RANGE[1]}), 0) AS share_target_outside
FROM j GROUP BY company""",
          digits={"median_deviation": RATIO, "mean_deviation": RATIO, "share_equal": RATIO, "median_rel_error": RATIO,
                  "median_within": RATIO, "mean_within": RATIO, "share_target_outside": RATIO},
          ids=("I20", "D13", "C22", "C24", "E2"))
def q_realised_expected(cat):
    f = fact(cat, [PREV - 1, PREV, CUR])
    cur = f.filter(F.col("year") == CUR).select("unit_id", "company", "market_value")
    prev = f.filter(F.col("year") == PREV).select("unit_id", "company", F.col("market_value").alias("prev_value"))
    a = f.filter(F.col("year") == PREV).select("unit_id", "company", F.col("market_value").alias("a"))
    b = f.filter(F.col("year") == PREV - 1).select("unit_id", "company", F.col("market_value").alias("b"))
    params = a.join(b, ["unit_id", "company"]).select(
        "unit_id", "company", ((F.col("a") - F.col("b")) / F.nullif(F.col("b"), F.lit(0))).alias("expected"))
    # the target is met by every second unit
    targets = cur.select("unit_id", "company", F.when(F.col("unit_id") % 2 == 0, F.col("market_value")).otherwise(F.lit(-1.0)).alias("target"))
    params = params.join(targets, ["unit_id", "company"])
    return OV.realised_vs_expected(cur, prev, params, ["unit_id", "company"], "company", "market_value",
                                   "prev_value", "expected", *REALISED_RANGE, target="target")


# ---------------------------------------------------------------- I22 / C9 / C16
PLAN_YEARS = list(range(1995, 2002))   # every order year of the test tables
PLAN_BINS = [(0, 0, "none"), (1, 2, "short"), (3, 4, "medium"), (5, 7, "long")]


@register("plan_length", f"""
WITH yearly AS (SELECT o_custkey,
   {", ".join(f"sum(o_totalprice) FILTER (WHERE year(o_orderdate) = {y}) AS value_{y}" for y in PLAN_YEARS)}
   FROM orders GROUP BY o_custkey),
c AS (SELECT {" + ".join(f"(CASE WHEN value_{y} > 0 THEN 1 ELSE 0 END)" for y in PLAN_YEARS)} AS k FROM yearly)
SELECT CASE {" ".join(f"WHEN k BETWEEN {lo} AND {hi} THEN '{lab}'" for lo, hi, lab in PLAN_BINS)} END AS bin,
       CASE {" ".join(f"WHEN k BETWEEN {lo} AND {hi} THEN {i}" for i, (lo, hi, lab) in enumerate(PLAN_BINS, start=1))} END AS bin_order,
       count(*) AS n
FROM c GROUP BY 1, 2""", ids=("I22", "C9", "C16"))
def q_plan_length(cat):
    o = cat["orders"].select("o_custkey", F.year("o_orderdate").alias("y"), "o_totalprice")
    wide = o.groupBy("o_custkey").pivot("y", PLAN_YEARS).agg(F.sum("o_totalprice"))
    wide = wide.select(*[F.col(str(y)).alias(f"value_{y}") for y in PLAN_YEARS])
    return OV.plan_length(wide, [f"value_{y}" for y in PLAN_YEARS], PLAN_BINS)


# ---------------------------------------------------------------- I23
@register("coverage", UY + f"""
, s AS (SELECT region, count(*) AS n_sample FROM unit_year WHERE year = {CUR} GROUP BY region),
pop AS (SELECT r_name AS region, count(*) AS n_population FROM customer
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name)
SELECT coalesce(s.region, pop.region) AS region, n_sample, n_population, n_sample / nullif(n_population, 0) AS coverage
FROM s FULL OUTER JOIN pop ON s.region = pop.region""", digits={"coverage": RATIO}, ids=("I23", "D11", "D7"))
def q_coverage(cat):
    from ..operators.joins import small_dim

    sample = fact(cat, [CUR]).groupBy("region").agg(F.count(F.lit(1)).alias("n_sample"))
    nation = small_dim(cat["nation"].select("n_nationkey", "n_regionkey"), 10_000)
    region = small_dim(cat["region"].select("r_regionkey", F.col("r_name").alias("region")), 10_000)
    pop = (cat["customer"].select("c_nationkey").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
           .join(region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("region")
           .agg(F.count(F.lit(1)).alias("n_population")))
    return OV.coverage(sample, pop, ["region"], "n_sample", "n_population")


# ---------------------------------------------------------------- I30 / D17
@register("region_fill", UY + f"""
, v AS (SELECT region, median(market_value) AS median_value, count(*) AS n FROM unit_year
        WHERE year = {CUR} AND n_orders >= 4 GROUP BY region)
SELECT r.r_name AS region, v.median_value, v.n, v.region IS NULL AS no_data
FROM region r LEFT JOIN v ON r.r_name = v.region""", digits={"median_value": MONEY}, ids=("I30", "D17"))
def q_region_fill(cat):
    from ..operators.aggregates import aggregate, median_of

    v = aggregate(fact(cat, [CUR]).filter(F.col("n_orders") >= 4), ["region"],
                  [median_of("market_value", "median_value"), F.count(F.lit(1)).alias("n")])
    regions = cat["region"].select(F.col("r_name").alias("region"))
    return OV.region_fill(v, regions, ["region"])

