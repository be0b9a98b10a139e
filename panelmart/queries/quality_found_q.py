"""The data-quality checks on inputs that do violate them.

The checks of ``quality_q`` hold on the derived models, so both sides of their
compare are empty; each check here has natural violations in the test tables
(``tests/test_quality.py`` asserts that it returns rows).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..registry import register
from .common import MONEY, UY, UY_PANEL, fact, p, panel

ACCTBAL_RANGE = (0.0, 5000.0)


@register("dq_not_null_found", UY_PANEL + f"""
SELECT unit_id, company, market_value, {p('market_value')} FROM panel WHERE market_value IS NULL OR {p('market_value')} IS NULL""",
          digits={"market_value": MONEY, p("market_value"): MONEY}, ids=("K1",))
def q_not_null(cat):
    cols = ["market_value", p("market_value")]
    return Q.not_null(panel(cat).select("unit_id", "company", *cols), cols)


@register("dq_binary_flag_found", UY + "SELECT unit_id, company, year, n_orders FROM unit_year WHERE n_orders NOT BETWEEN 0 AND 1", ids=("K5",))
def q_binary_flag(cat):
    return Q.binary_flag(fact(cat).select("unit_id", "company", "year", "n_orders"), ["n_orders"])


@register("dq_in_range_found", f"""
SELECT c_custkey, c_acctbal FROM customer WHERE NOT c_acctbal BETWEEN {ACCTBAL_RANGE[0]} AND {ACCTBAL_RANGE[1]}""",
          digits={"c_acctbal": MONEY}, ids=("K6",))
def q_in_range(cat):
    return Q.in_range(cat["customer"].select("c_custkey", "c_acctbal"), "c_acctbal", *ACCTBAL_RANGE)


@register("dq_components_sum_found", UY + """
SELECT unit_id, company, year FROM unit_year WHERE abs(policy_value - coalesce(gross_value, 0) + coalesce(tax_value, 0)) > 0.01""", ids=("K8",))
def q_components_sum(cat):
    return Q.components_sum(fact(cat), "policy_value", [("gross_value", 1), ("tax_value", -1)], 0.01).select("unit_id", "company", "year")


@register("dq_implies_found", UY + """
SELECT unit_id, company, year FROM unit_year WHERE (valuation_type = 'Full') <> (n_orders > 1)""", ids=("K9",))
def q_implies(cat):
    return Q.implies(fact(cat), F.col("valuation_type") == "Full", F.col("n_orders") > 1).select("unit_id", "company", "year")


@register("dq_foreign_key_found", "SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id) WHERE doc_id IS NOT NULL", ids=("K10", "D18"))
def q_foreign_key(cat):
    return Q.foreign_key(cat["documents"].select("doc_id"), cat["labels"].select(F.col("doc_id").alias("labelled")), "doc_id", "labelled")


@register("dq_subset_of_found", """
SELECT l_suppkey AS k, l_partkey AS v FROM lineitem WHERE l_returnflag = 'R'
  AND (l_suppkey, l_partkey) NOT IN (SELECT (l_suppkey, l_partkey) FROM lineitem WHERE l_returnflag = 'N')""", ids=("K11",))
def q_subset_of(cat):
    pairs = cat["lineitem"].select(F.col("l_suppkey").alias("k"), F.col("l_partkey").alias("v"), "l_returnflag")
    sub, sup = (pairs.filter(F.col("l_returnflag") == f).select("k", "v") for f in ("R", "N"))
    return Q.subset_of(sub, sup, ["k", "v"])


@register("dq_attribute_found", """
SELECT l_orderkey FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
WHERE coalesce(o_orderstatus, '') <> 'F'""", ids=("K11",))
def q_attribute(cat):
    sub = cat["lineitem"].select("l_orderkey")
    sup = cat["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    return Q.attribute_check(sub, sup, ["l_orderkey"], F.col("o_orderstatus") == "F").select("l_orderkey")


@register("dq_monotonic_found", """
SELECT o.month, o.n_units, b.n_units AS previous_value
FROM (SELECT month(o_orderdate) AS month, count(*) AS n_units FROM orders GROUP BY 1) o
JOIN (SELECT month(o_orderdate) AS month, count(*) AS n_units FROM orders GROUP BY 1) b ON b.month = o.month - 1
WHERE o.n_units > b.n_units""", ids=("K12", "F13"))
def q_monotonic(cat):
    months = cat["orders"].groupBy(F.month("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("n_units"))
    return Q.monotonic(months, "month", "n_units")


@register("dq_chain_complete_found", UY + "SELECT unit_id, company, year FROM unit_year WHERE n_orders IS NOT NULL AND policy_value IS NULL", ids=("K14",))
def q_chain_complete(cat):
    return Q.chain_complete(fact(cat), "n_orders", ["policy_value"]).select("unit_id", "company", "year")


@register("dq_mixed_found", UY + """
SELECT 'policy_value is null' AS issue, CAST(unit_id AS VARCHAR) AS key_value FROM unit_year WHERE policy_value IS NULL
UNION ALL SELECT 'unit_id not unique', CAST(unit_id AS VARCHAR) FROM unit_year GROUP BY unit_id HAVING count(*) > 1""", ids=("K15",))
def q_mixed(cat):
    return Q.mixed_checks(fact(cat).select("unit_id", "policy_value"), ["policy_value"], "unit_id")


FOUND = ["dq_not_null_found", "dq_binary_flag_found", "dq_in_range_found", "dq_components_sum_found", "dq_implies_found", "dq_foreign_key_found",
         "dq_subset_of_found", "dq_attribute_found", "dq_monotonic_found", "dq_chain_complete_found", "dq_mixed_found"]
