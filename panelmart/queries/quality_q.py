"""Data-quality queries K1–K16 over the test tables and the derived models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..registry import register
from .common import CUR, MONEY, NET, RATIO, UY, UY_PANEL, fact, p, panel
from .funnel_q import FUNNEL_CTES, FUNNEL_LABELS, funnel_annotated, stage_sql
from .merge_q import geo_chain_plan
from ..plans.funnel import funnel_result, funnel_stats

# Fixed parameters of the stand-in checks.
ORDER_STATUS_ACCEPTED = ["F", "O"]
DISCOUNT_RANGE = (0.0, 0.1)
TAX_RANGE = (0.0, 0.08)
POLICY_TOLERANCE = 0.5          # policy value may exceed market value by 50 %
COMPONENT_TOLERANCE = 0.01
YOY_RANGE = (-0.9, 10.0)


@register("dq_not_null", UY + f"""
SELECT unit_id, company, year FROM unit_year WHERE unit_id IS NULL OR company IS NULL OR year IS NULL OR region IS NULL""",
          ids=("K1",))
def q_dq_not_null(cat):
    return Q.not_null(fact(cat), ["unit_id", "company", "year", "region"]).select("unit_id", "company", "year")


@register("dq_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
          ids=("K2",))
def q_dq_unique(cat):
    return Q.unique(cat["lineitem"], ["l_orderkey", "l_linenumber"])


@register("dq_fanout", UY + """
SELECT unit_id, company, year, count(*) AS n FROM unit_year GROUP BY unit_id, company, year HAVING count(*) > 1""",
          ids=("K2",))
def q_dq_fanout(cat):
    return Q.unique(fact(cat), ["unit_id", "company", "year"])


@register("dq_unique_not_null", """
SELECT CAST(p_name AS VARCHAR) AS key_value, count(*) AS n, 'duplicate' AS issue FROM part
GROUP BY p_name HAVING count(*) > 1
UNION ALL
SELECT NULL AS key_value, n, 'null' AS issue FROM (SELECT count(*) FILTER (WHERE p_name IS NULL) AS n FROM part) WHERE n > 0""",
          ids=("K3",))
def q_dq_unique_not_null(cat):
    return Q.unique_not_null(cat["part"], "p_name")


@register("dq_accepted_values", f"""
SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderstatus IN ({", ".join(f"'{v}'" for v in ORDER_STATUS_ACCEPTED)}))""",
          ids=("K4",))
def q_dq_accepted_values(cat):
    return Q.accepted_values(cat["orders"].select("o_orderkey", "o_orderstatus"), "o_orderstatus", ORDER_STATUS_ACCEPTED)


@register("dq_binary_flag", """
SELECT doc_id, quality, toxic FROM labels
WHERE NOT coalesce(quality IN (0, 1), true) OR NOT coalesce(toxic IN (0, 1), true)""", ids=("K5",))
def q_dq_binary_flag(cat):
    return Q.binary_flag(cat["labels"].select("doc_id", "quality", "toxic"), ["quality", "toxic"])


@register("dq_in_range", f"""
SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount < {DISCOUNT_RANGE[0]} OR l_discount > {DISCOUNT_RANGE[1]}
UNION ALL
SELECT l_orderkey, l_linenumber, l_tax FROM lineitem WHERE l_tax < {TAX_RANGE[0]} OR l_tax > {TAX_RANGE[1]}""",
          ids=("K6",))
def q_dq_in_range(cat):
    li = cat["lineitem"]
    a = Q.in_range(li, "l_discount", *DISCOUNT_RANGE).select("l_orderkey", "l_linenumber", "l_discount")
    b = Q.in_range(li, "l_tax", *TAX_RANGE).select("l_orderkey", "l_linenumber", F.col("l_tax").alias("l_discount"))
    return a.unionByName(b)


@register("dq_rule", UY + f"""
SELECT unit_id, company, year, market_value, policy_value FROM unit_year
WHERE NOT (policy_value <= market_value * (1 + {POLICY_TOLERANCE}))""",
          digits={"market_value": MONEY, "policy_value": NET}, ids=("K7",))
def q_dq_rule(cat):
    f = fact(cat).select("unit_id", "company", "year", "market_value", "policy_value")
    return Q.rule(f, F.col("policy_value") <= F.col("market_value") * F.lit(1 + POLICY_TOLERANCE))


@register("dq_components_sum", UY + f"""
SELECT unit_id, company, year FROM unit_year
WHERE abs(policy_value - (coalesce(gross_value, 0.0) - coalesce(discount_value, 0.0))) > {COMPONENT_TOLERANCE}""",
          ids=("K8",))
def q_dq_components_sum(cat):
    f = fact(cat)
    return Q.components_sum(f, "policy_value", [("gross_value", 1), ("discount_value", -1)], COMPONENT_TOLERANCE).select(
        "unit_id", "company", "year")


@register("dq_implies", UY + """
SELECT unit_id, company, year FROM unit_year
WHERE (valuation_type = 'Full' AND NOT (n_full > 0)) OR (n_full > 0 AND NOT (valuation_type = 'Full'))""",
          ids=("K9",))
def q_dq_implies(cat):
    return Q.implies(fact(cat), F.col("valuation_type") == "Full", F.col("n_full") > 0).select("unit_id", "company", "year")


@register("dq_foreign_key", """
SELECT 'lineitem.l_partkey' AS relation, CAST(l_partkey AS BIGINT) AS key_value FROM lineitem
WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL)
UNION ALL
SELECT 'orders.o_custkey', CAST(o_custkey AS BIGINT) FROM orders
WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)
UNION ALL
SELECT 'lineitem.l_orderkey', CAST(l_orderkey AS BIGINT) FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)
UNION ALL
SELECT 'labels.doc_id', CAST(doc_id AS BIGINT) FROM labels
WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL)""", ids=("K10", "D18"))
def q_dq_foreign_key(cat):
    rels = [("lineitem.l_partkey", cat["lineitem"], "l_partkey", cat["part"], "p_partkey"),
            ("orders.o_custkey", cat["orders"], "o_custkey", cat["customer"], "c_custkey"),
            ("lineitem.l_orderkey", cat["lineitem"], "l_orderkey", cat["orders"], "o_orderkey"),
            ("labels.doc_id", cat["labels"], "doc_id", cat["documents"], "doc_id")]
    parts = [Q.foreign_key(c.select(ck), pa.select(pk), ck, pk).select(
        F.lit(name).alias("relation"), F.col(ck).cast("long").alias("key_value")) for name, c, ck, pa, pk in rels]
    out = parts[0]
    for d in parts[1:]:
        out = out.unionByName(d)
    return out


@register("dq_subset_of", FUNNEL_CTES + f"""
SELECT s.unit_id, s.company FROM {stage_sql(5)} s
WHERE NOT EXISTS (SELECT 1 FROM unit_year u WHERE u.year = {CUR} AND u.unit_id = s.unit_id AND u.company = s.company)
UNION ALL
SELECT s.unit_id, s.company FROM {stage_sql(5)} s LEFT JOIN (SELECT * FROM unit_year WHERE year = {CUR}) u
  ON u.unit_id = s.unit_id AND u.company = s.company
WHERE NOT coalesce(u.model = 'Residential', false)""", ids=("K11",))
def q_dq_subset_of(cat):
    sub = funnel_result(funnel_annotated(cat), len(FUNNEL_LABELS) - 1).select("unit_id", "company")
    sup = fact(cat, [CUR])
    a = Q.subset_of(sub, sup, ["unit_id", "company"])
    b = Q.attribute_check(sub, sup.select("unit_id", "company", "model"), ["unit_id", "company"],
                          F.col("model") == "Residential").select("unit_id", "company")
    return a.unionByName(b)


@register("dq_monotonic", FUNNEL_CTES + ", stats AS (" + "\nUNION ALL\n".join(
    f"SELECT {i} AS step_no, count(*) AS n_units FROM {stage_sql(i)} st"
    for i in range(len(FUNNEL_LABELS))) + """)
SELECT step_no, n_units, previous_value FROM (
  SELECT step_no, n_units, lag(n_units) OVER (ORDER BY step_no) AS previous_value FROM stats) s
WHERE n_units > previous_value""", ids=("K12", "F13"))
def q_dq_monotonic(cat):
    st = funnel_stats(funnel_annotated(cat), FUNNEL_LABELS, "company", "complex", "unit_type", "market_value")
    return Q.monotonic(st.select("step_no", "n_units"), "step_no", "n_units")


@register("dq_yoy_bounds", UY_PANEL + f"""
SELECT unit_id, company, market_value, {p('market_value')},
       (market_value - {p('market_value')}) / nullif({p('market_value')}, 0) AS yoy_change
FROM panel WHERE _merge = 'both'
  AND ((market_value - {p('market_value')}) / nullif({p('market_value')}, 0) < {YOY_RANGE[0]}
       OR (market_value - {p('market_value')}) / nullif({p('market_value')}, 0) > {YOY_RANGE[1]})""",
          digits={"market_value": MONEY, p("market_value"): MONEY, "yoy_change": RATIO}, ids=("K13", "C12"))
def q_dq_yoy_bounds(cat):
    m = panel(cat).filter(F.col("_merge") == "both").select("unit_id", "company", "market_value", p("market_value"))
    return Q.yoy_bounds(m, "market_value", p("market_value"), *YOY_RANGE)


@register("dq_chain_complete", """
SELECT c_custkey FROM (
  SELECT c_custkey, c_nationkey, n.n_name, r.r_name
  FROM customer c
  LEFT JOIN nation n ON 'GM' || lpad(CAST(c.c_nationkey AS VARCHAR), 4, '0') = 'GM' || lpad(CAST(n.n_nationkey AS VARCHAR), 4, '0')
  LEFT JOIN region r ON 'RG' || lpad(CAST(n.n_regionkey AS VARCHAR), 2, '0') = 'RG' || lpad(CAST(r.r_regionkey AS VARCHAR), 2, '0')
) g WHERE c_nationkey IS NOT NULL AND (n_name IS NULL OR r_name IS NULL)""", ids=("K14",))
def q_dq_chain_complete(cat):
    return Q.chain_complete(geo_chain_plan(cat), "c_nationkey", ["n_name", "r_name"]).select("c_custkey")


@register("dq_mixed", """
SELECT 'c_name is null' AS issue, CAST(c_custkey AS VARCHAR) AS key_value FROM customer WHERE c_name IS NULL
UNION ALL
SELECT 'c_mktsegment is null', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment IS NULL
UNION ALL
SELECT 'c_custkey not unique', CAST(c_custkey AS VARCHAR) FROM customer GROUP BY c_custkey HAVING count(*) > 1""",
          ids=("K15",))
def q_dq_mixed(cat):
    return Q.mixed_checks(cat["customer"], ["c_name", "c_mktsegment"], "c_custkey")


_REPORT = [("fact_not_null", "dq_not_null", "error", 1), ("lineitem_unique", "dq_unique", "warn", 1),
           ("fact_no_fanout", "dq_fanout", "error", 1), ("orders_status_accepted", "dq_accepted_values", "warn", 1),
           ("labels_binary", "dq_binary_flag", "error", 1), ("lineitem_ranges", "dq_in_range", "error", 1),
           ("policy_le_market", "dq_rule", "warn", 10), ("components_sum", "dq_components_sum", "error", 1),
           ("type_implies_full", "dq_implies", "error", 1), ("foreign_keys", "dq_foreign_key", "warn", 1),
           ("yoy_bounds", "dq_yoy_bounds", "warn", 5), ("geo_chain_complete", "dq_chain_complete", "error", 1)]


def _row_rules(f):
    """Row-level rules on the fact (checked in one scan by ``run_report``); each
    violation predicate is the negation of the rule used by its ``dq_*`` query."""
    return {
        "fact_not_null": F.col("unit_id").isNull() | F.col("company").isNull() | F.col("year").isNull()
        | F.col("region").isNull(),
        "policy_le_market": ~(F.col("policy_value") <= F.col("market_value") * F.lit(1 + POLICY_TOLERANCE)),
        "components_sum": F.abs(F.col("policy_value") - (F.coalesce(F.col("gross_value"), F.lit(0.0))
                                                        - F.coalesce(F.col("discount_value"), F.lit(0.0))))
        > F.lit(COMPONENT_TOLERANCE),
        "type_implies_full": ((F.col("valuation_type") == "Full") & ~(F.col("n_full") > 0))
        | ((F.col("n_full") > 0) & ~(F.col("valuation_type") == "Full")),
    }


def dq_checks(cat):
    """The suite run by ``dq_report`` (name, violating rows or a row rule, severity, threshold)."""
    from ..registry import REGISTRY

    f = fact(cat)
    rules = _row_rules(f)
    out = []
    for name, q, sev, lim in _REPORT:
        if name in rules:
            out.append(Q.RowCheck(name, f, rules[name], sev, warn_if=lim, error_if=lim))
        else:
            out.append(Q.Check(name, REGISTRY[q].build(cat), sev, warn_if=lim, error_if=lim))
    return out


def _report_sql() -> str:
    from ..registry import REGISTRY

    arms = []
    for name, q, sev, lim in _REPORT:
        body = REGISTRY[q].sql
        bad = "fail" if sev == "error" else "warn"
        arms.append(f"SELECT '{name}' AS check_name, '{sev}' AS severity, count(*) AS violations, "
                    f"CASE WHEN count(*) >= {lim} THEN '{bad}' ELSE 'pass' END AS status FROM ({body}) x")
    return "\nUNION ALL\n".join(arms)


@register("dq_report", _report_sql(), ids=("K16",))
def q_dq_report(cat):
    return Q.run_report(dq_checks(cat))

