"""Merge queries: I2, I3 (both forms), D2, D5, D7, D8, D9, D10, I4."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import geo_key, mean_cols, rate_by
from ..operators import joins as J
from ..registry import register
from ..sources.standin import ORDER_VALUES_SQL, order_values, with_sql
from .common import CUR, MEAN, MONEY, NET, TAX, UY, fact

_MERGE_CASE = """CASE WHEN {l} IS NOT NULL AND {r} IS NOT NULL THEN 'both'
                WHEN {l} IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS _merge"""


# ---------------------------------------------------------------- I2 / D1 / C1 / C2
@register("indicator_merge", with_sql(ORDER_VALUES_SQL) + f"""
SELECT coalesce(o.o_orderkey, v.o_orderkey) AS o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderstatus,
       v.gross_value, v.discount_value, v.net_value, v.tax_value,
       {_MERGE_CASE.format(l='o.o_orderkey', r='v.o_orderkey')}
FROM (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders) o
FULL OUTER JOIN (SELECT l_orderkey AS o_orderkey, gross_value, discount_value, net_value, tax_value FROM order_values) v
  ON o.o_orderkey = v.o_orderkey""",
          digits={"gross_value": MONEY, "discount_value": NET, "net_value": NET, "tax_value": TAX},
          ids=("I2", "D1", "C1", "C2"))
def q_indicator_merge(cat):
    o = cat["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    v = order_values(cat).withColumnRenamed("l_orderkey", "o_orderkey")
    return J.indicator_merge(o, v, ["o_orderkey"], drop_right=["n_lines"])


# ---------------------------------------------------------------- I3 / D3 / R8
_STAR_YEARS = (1998, 1999, 2000)


def _star_inputs(cat):
    base = cat["customer"].filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("unit_id"), F.col("c_acctbal").alias("acctbal"))
    o = cat["orders"].select("o_custkey", F.year("o_orderdate").alias("y"), "o_totalprice")
    others = [
        o.filter(F.col("y") == y).groupBy("o_custkey").agg(F.sum("o_totalprice").alias(f"value_{y}"))
        .withColumnRenamed("o_custkey", "unit_id")
        for y in _STAR_YEARS
    ]
    return base, others


_STAR_SQL = """
WITH base AS (SELECT c_custkey AS unit_id, c_acctbal AS acctbal FROM customer WHERE c_mktsegment = 'BUILDING'),
{inputs}
SELECT coalesce(base.unit_id, {coalesce}) AS unit_id, base.acctbal, {values}
FROM base {joins}""".format(
    inputs=",\n".join(
        f"o{y} AS (SELECT o_custkey AS unit_id, sum(o_totalprice) AS value_{y} FROM orders "
        f"WHERE year(o_orderdate) = {y} GROUP BY o_custkey)" for y in _STAR_YEARS),
    coalesce=", ".join(f"o{y}.unit_id" for y in _STAR_YEARS),
    values=", ".join(f"o{y}.value_{y}" for y in _STAR_YEARS),
    joins=" ".join(f"FULL OUTER JOIN o{y} ON base.unit_id = o{y}.unit_id" for y in _STAR_YEARS),
)
_STAR_DIGITS = {"acctbal": MONEY, **{f"value_{y}": MONEY for y in _STAR_YEARS}}


@register("star_full_outer", _STAR_SQL, digits=_STAR_DIGITS, ids=("I3", "D3", "R8"))
def q_star_full_outer(cat):
    base, others = _star_inputs(cat)
    return J.star_full_outer(base, others, ["unit_id"], method="union")


@register("star_full_outer_chain", _STAR_SQL, digits=_STAR_DIGITS, ids=("I3", "D3"))
def q_star_full_outer_chain(cat):
    base, others = _star_inputs(cat)
    return J.star_full_outer(base, others, ["unit_id"], method="chain")


# ---------------------------------------------------------------- D2
def _year_value(cat, y):
    return (cat["orders"].filter(F.year("o_orderdate") == y).groupBy("o_custkey")
            .agg(F.sum("o_totalprice").alias(f"value_{y}")).withColumnRenamed("o_custkey", "unit_id"))


@register("three_way_full_outer", """
WITH a AS (SELECT o_custkey AS unit_id, sum(o_totalprice) AS value_2000 FROM orders WHERE year(o_orderdate) = 2000 GROUP BY 1),
b AS (SELECT o_custkey AS unit_id, sum(o_totalprice) AS value_1999 FROM orders WHERE year(o_orderdate) = 1999 GROUP BY 1),
c AS (SELECT o_custkey AS unit_id, sum(o_totalprice) AS value_1998 FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1)
SELECT coalesce(a.unit_id, b.unit_id, c.unit_id) AS unit_id, a.value_2000, b.value_1999, c.value_1998
FROM a FULL OUTER JOIN b ON a.unit_id = b.unit_id
FULL OUTER JOIN c ON coalesce(a.unit_id, b.unit_id) = c.unit_id""",
          digits={"value_2000": MONEY, "value_1999": MONEY, "value_1998": MONEY}, ids=("D2", "C2"))
def q_three_way_full_outer(cat):
    return J.full_outer3(_year_value(cat, 2000), _year_value(cat, 1999), _year_value(cat, 1998), ["unit_id"])


# ---------------------------------------------------------------- D5
@register("join_filtered", f"""
SELECT c_mktsegment, count(*) AS n_orders, sum(o_totalprice) AS total_value
FROM orders JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0
WHERE year(o_orderdate) = {CUR}
GROUP BY c_mktsegment""", digits={"total_value": MONEY}, ids=("D5",))
def q_join_filtered(cat):
    o = cat["orders"].filter(F.year("o_orderdate") == CUR).select("o_custkey", "o_totalprice")
    c = cat["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    j = J.join_filtered(o, c, ["o_custkey"], F.col("c_acctbal") > 0)
    return j.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total_value"))


# ---------------------------------------------------------------- D6 / D7 / H8
def geo_chain_plan(cat):
    cust = cat["customer"].select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = cat["nation"].select(geo_key("n_nationkey", "GM", 4).alias("gm_code"), "n_name",
                                  geo_key("n_regionkey", "RG", 2).alias("n_region_code"))
    region = cat["region"].select(geo_key("r_regionkey", "RG", 2).alias("rg_code"), "r_name")
    out = J.geo_chain(cust, [
        (geo_key("c_nationkey", "GM", 4), nation, "gm_code"),
        (F.col("n_region_code"), region, "rg_code"),
    ])
    return out.select("c_custkey", "c_nationkey", "c_mktsegment", "n_name", "r_name",
                      F.substring("n_name", 1, 4).alias("name_prefix"))


@register("geo_chain", """
SELECT c_custkey, c_nationkey, c_mktsegment, n.n_name, r.r_name, substring(n.n_name, 1, 4) AS name_prefix
FROM customer c
LEFT JOIN (SELECT 'GM' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS gm_code, n_name,
                  'RG' || lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS n_region_code FROM nation) n
  ON 'GM' || lpad(CAST(c.c_nationkey AS VARCHAR), 4, '0') = n.gm_code
LEFT JOIN (SELECT 'RG' || lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS rg_code, r_name FROM region) r
  ON n.n_region_code = r.rg_code""", ids=("D7", "D6", "H8"))
def q_geo_chain(cat):
    return geo_chain_plan(cat)


# ---------------------------------------------------------------- D8
@register("group_anti", UY + f"""
SELECT unit_id, company, complex, unit_type, market_value FROM unit_year t
WHERE year = {CUR} AND NOT EXISTS (
  SELECT 1 FROM unit_year x WHERE x.year = {CUR} AND x.unit_type = 'negative'
    AND x.company = t.company AND x.complex = t.complex)""", digits={"market_value": MONEY}, ids=("D8", "H5"))
def q_group_anti(cat):
    f = fact(cat, [CUR]).select("unit_id", "company", "complex", "unit_type", "market_value")
    return J.exclude_groups(f, ["company", "complex"], F.col("unit_type") == "negative")


# ---------------------------------------------------------------- D9
@register("exclude_not_in", UY + f"""
SELECT unit_id, company, market_value FROM unit_year
WHERE year = {CUR} AND company NOT IN (SELECT n_name FROM nation WHERE n_regionkey = 1)""",
          digits={"market_value": MONEY}, ids=("D9", "C21"))
def q_exclude_not_in(cat):
    f = fact(cat, [CUR]).select("unit_id", "company", "market_value")
    return J.exclude_listed(f, "company", cat["nation"], "n_name", F.col("n_regionkey") == 1)


# ---------------------------------------------------------------- D10
@register("keep_groups", UY + f"""
SELECT unit_id, company, market_value FROM unit_year
WHERE year = {CUR} AND company IN (SELECT company FROM unit_year WHERE year = {CUR} GROUP BY company HAVING count(*) > 45)""",
          digits={"market_value": MONEY}, ids=("D10", "E12"))
def q_keep_groups(cat):
    f = fact(cat, [CUR]).select("unit_id", "company", "market_value")
    return J.keep_groups(f, ["company"], F.col("n") > 45, [F.count(F.lit(1)).alias("n")])


# ---------------------------------------------------------------- I4 build_fact
SEGMENT_RATES = {("BUILDING", 1999): 0.045, ("BUILDING", 2000): 0.05, ("MACHINERY", 2000): 0.055}
_YEARS = list(range(1995, 2002))   # every order year of the test tables


def build_fact_plan(cat):
    """I4: wide mart from a unit base, several per-unit inputs and the geography chain.

    Base = customers; inputs = yearly order values pivoted to columns (one
    aggregate + pivot, not one join per year), current-year valuation
    (orders) and policy (line net) aggregates, all star-joined on the unit key
    (R8 union form); then the computed-key geography chain (D7), means over
    the yearly columns in both NULL conventions (C7/C8) and a parameter rate
    (C10).
    """
    base = cat["customer"].select(F.col("c_custkey").alias("unit_id"), "c_nationkey",
                                  F.col("c_mktsegment").alias("segment"))
    o = cat["orders"].select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"), "o_totalprice")
    yearly = (o.filter(F.col("y").isin(_YEARS)).groupBy(F.col("o_custkey").alias("unit_id"))
              .pivot("y", _YEARS).agg(F.sum("o_totalprice")))
    yearly = yearly.select("unit_id", *[F.col(str(y)).alias(f"value_{y}") for y in _YEARS])
    valuation = (o.filter(F.col("y") == CUR).groupBy(F.col("o_custkey").alias("unit_id"))
                 .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("market_value")))
    ov = order_values(cat)
    policy = (o.filter(F.col("y") == CUR).join(ov, F.col("o_orderkey") == F.col("l_orderkey"))
              .groupBy(F.col("o_custkey").alias("unit_id")).agg(F.sum("net_value").alias("policy_value")))
    wide = J.star_full_outer(base, [yearly, valuation, policy], ["unit_id"], method="union")
    nation = cat["nation"].select(geo_key("n_nationkey", "GM", 4).alias("gm_code"), F.col("n_name").alias("company"), "n_regionkey")
    region = cat["region"].select("r_regionkey", F.col("r_name").alias("region"))
    wide = J.geo_chain(wide, [(geo_key("c_nationkey", "GM", 4), nation, "gm_code"),
                              (F.col("n_regionkey"), region, "r_regionkey")])
    ycols = [f"value_{y}" for y in _YEARS]
    return wide.select(
        "unit_id", "company", "region", "segment", *ycols, "n_orders", "market_value", "policy_value",
        mean_cols(ycols, default=0.0).alias("mean_value_zero"),
        mean_cols(ycols, default=None).alias("mean_value_strict"),
        rate_by("segment", F.lit(CUR), SEGMENT_RATES, default=0.04).alias("rate"),
    )


def _build_fact_sql() -> str:
    pivots = ", ".join(f"sum(o_totalprice) FILTER (WHERE year(o_orderdate) = {y}) AS value_{y}" for y in _YEARS)
    ycols = [f"value_{y}" for y in _YEARS]
    zero = " + ".join(f"coalesce({c}, 0.0)" for c in ycols)
    strict = " + ".join(ycols)
    rate = " ".join(f"WHEN segment = '{s}' AND {CUR} = {y} THEN {v}" for (s, y), v in SEGMENT_RATES.items())
    return with_sql(ORDER_VALUES_SQL) + f""",
base AS (SELECT c_custkey AS unit_id, c_nationkey, c_mktsegment AS segment FROM customer),
yearly AS (SELECT o_custkey AS unit_id, {pivots} FROM orders
           WHERE year(o_orderdate) BETWEEN {_YEARS[0]} AND {_YEARS[-1]} GROUP BY o_custkey),
valuation AS (SELECT o_custkey AS unit_id, count(*) AS n_orders, sum(o_totalprice) AS market_value
              FROM orders WHERE year(o_orderdate) = {CUR} GROUP BY o_custkey),
policy AS (SELECT o_custkey AS unit_id, sum(net_value) AS policy_value
           FROM orders JOIN order_values ON o_orderkey = l_orderkey
           WHERE year(o_orderdate) = {CUR} GROUP BY o_custkey),
wide AS (
  SELECT coalesce(base.unit_id, yearly.unit_id, valuation.unit_id, policy.unit_id) AS unit_id,
         base.c_nationkey, base.segment, {", ".join(ycols)}, n_orders, market_value, policy_value
  FROM base
  FULL OUTER JOIN yearly ON base.unit_id = yearly.unit_id
  FULL OUTER JOIN valuation ON base.unit_id = valuation.unit_id
  FULL OUTER JOIN policy ON base.unit_id = policy.unit_id
)
SELECT unit_id, n.n_name AS company, r.r_name AS region, segment, {", ".join(ycols)},
       n_orders, market_value, policy_value,
       ({zero}) / {float(len(ycols))} AS mean_value_zero,
       ({strict}) / {float(len(ycols))} AS mean_value_strict,
       CAST(CASE {rate} ELSE 0.04 END AS DOUBLE) AS rate
FROM wide
LEFT JOIN nation n ON 'GM' || lpad(CAST(wide.c_nationkey AS VARCHAR), 4, '0') = 'GM' || lpad(CAST(n.n_nationkey AS VARCHAR), 4, '0')
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""


@register("build_fact", _build_fact_sql(),
          digits={**{f"value_{y}": MONEY for y in _YEARS}, "market_value": MONEY, "policy_value": NET,
                  "mean_value_zero": MEAN, "mean_value_strict": MEAN},
          ids=("I4", "D3", "D6", "D7", "C7", "C8", "C10"))
def q_build_fact(cat):
    return build_fact_plan(cat)

