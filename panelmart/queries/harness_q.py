
from __future__ import annotations

from pyspark.sql import functions as F

from ..registry import register
from ..sources.standin import ORDER_VALUES_SQL, with_sql
from .common import MEAN, MONEY, UY, UY_PANEL, fact, panel
from .funnel_q import FUNNEL_CTES, FUNNEL_LABELS, funnel_annotated
from .merge_q import _build_fact_sql, build_fact_plan, q_indicator_merge

HARNESS_COMPANY = "NATION_1"


@register("fact_count", UY + "SELECT count(*) AS n FROM unit_year", ids=("E1",))
def q_fact_count(cat):
    return fact(cat).agg(F.count(F.lit(1)).alias("n"))


@register("fact_count_company", UY + f"SELECT count(*) AS n FROM unit_year WHERE company = '{HARNESS_COMPANY}'", ids=("E1",))
def q_fact_count_company(cat):
    return fact(cat).filter(F.col("company") == HARNESS_COMPANY).agg(F.count(F.lit(1)).alias("n"))


@register("sum_by_company_model", UY + """
SELECT company, model, sum(market_value) AS total_value, count(*) AS n FROM unit_year GROUP BY company, model""",
          digits={"total_value": MONEY}, ids=("E1",))
def q_sum_by_company_model(cat):
    return fact(cat).groupBy("company", "model").agg(F.sum("market_value").alias("total_value"), F.count(F.lit(1)).alias("n"))


@register("validation_count", FUNNEL_CTES + "SELECT count(*) AS n FROM funnel WHERE reached = 5", ids=("I6",))
def q_validation_count(cat):
    from ..plans.funnel import funnel_result

    return funnel_result(funnel_annotated(cat), len(FUNNEL_LABELS) - 1).agg(F.count(F.lit(1)).alias("n"))


@register("panel_avg_by_company", UY_PANEL + """
SELECT company, count(*) AS n, avg(market_value) AS avg_value FROM panel GROUP BY company""",
          digits={"avg_value": MEAN}, ids=("I5",))
def q_panel_avg_by_company(cat):
    return panel(cat).groupBy("company").agg(F.count(F.lit(1)).alias("n"), F.avg("market_value").alias("avg_value"))


@register("full_outer_notnull_count", with_sql(ORDER_VALUES_SQL) + """
SELECT count(*) AS n FROM orders o FULL OUTER JOIN order_values v ON o.o_orderkey = v.l_orderkey
WHERE v.net_value IS NOT NULL""", ids=("D1",))
def q_full_outer_notnull_count(cat):
    return q_indicator_merge(cat).filter(F.col("net_value").isNotNull()).agg(F.count(F.lit(1)).alias("n"))


@register("wide_param_count", f"SELECT count(*) AS n FROM ({_build_fact_sql()}) w", ids=("I4",))
def q_wide_param_count(cat):
    return build_fact_plan(cat).agg(F.count(F.lit(1)).alias("n"))


@register("sum_by_region_company", UY + """
SELECT region, company, count(*) AS n, sum(market_value) AS total_value FROM unit_year GROUP BY region, company""",
          digits={"total_value": MONEY}, ids=("E1", "H2"))
def q_sum_by_region_company(cat):
    return (fact(cat).groupBy("region", "company").agg(F.count(F.lit(1)).alias("n"), F.sum("market_value").alias("total_value"))
            .orderBy(F.col("total_value").desc()))


@register("count_by_model_flag", UY + """
SELECT model, own_input, count(*) AS n FROM unit_year GROUP BY model, own_input""", ids=("E1",))
def q_count_by_model_flag(cat):
    return fact(cat).groupBy("model", "own_input").agg(F.count(F.lit(1)).alias("n"))


@register("complex_having", UY + """
SELECT complex, company, count(*) AS n, sum(market_value) AS total_value, avg(market_value) AS avg_value
FROM unit_year GROUP BY complex, company HAVING count(*) > 1""",
          digits={"total_value": MONEY, "avg_value": MEAN}, ids=("E12",))
def q_complex_having(cat):
    g = fact(cat).groupBy("complex", "company").agg(F.count(F.lit(1)).alias("n"), F.sum("market_value").alias("total_value"),
                                                    F.avg("market_value").alias("avg_value"))
    return g.filter(F.col("n") > 1)

