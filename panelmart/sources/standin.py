"""Domain models derived from the driver's test tables.

The reference's raw tables (units, valuations, parameters) are private, so the
registered queries run on models that Spark derives from the TPC-H-style
tables; their work grows with those tables.  Mapping:

    unit            customer            (unit_id = c_custkey)
    company         nation name         (25)
    region          region name         (5)
    complex         market segment      (within a company)
    unit_type       band of the account balance
    model           'Residential' / 'Other' (balance sign)
    year            year of the order date
    market_value    sum of order totals of the unit-year
    policy_value    sum of net line values (NULL when no order has lines)
    value parts     gross, discount, tax sums of the lines
    valuation_type  'Full' when any order of the year is finished, else 'Basis'
    own_input       1 when any order of the year is urgent

Each model has a Spark builder and the equal SQL text for the DuckDB oracle;
every registered query built on them is checked against that SQL.

Plan notes (scale): lineitem is pre-aggregated per order before it meets
orders (partial aggregation map-side, so the join shuffles one row per order,
not per line); the order join is a shuffle join on the order key; the
unit-year aggregate shuffles on (customer, year); customer is joined by
shuffle (it grows with the data), nation and region are broadcast behind a
row-count check (``small_dim``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import small_dim
from .tables import Catalog

# Fixed values of the stand-in mapping (parameters of the queries, kept together).
URGENT_PRIORITY = "1-URGENT"
FINISHED_STATUS = "F"
BALANCE_BANDS = ((0.0, "negative"), (3000.0, "low"), (6000.0, "mid"))  # upper edges; rest 'high'


def order_values(cat: Catalog) -> DataFrame:
    """Line values per order (partial aggregate before the order join)."""
    li = cat["lineitem"]
    price, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    net = price * (F.lit(1) - disc)
    return li.groupBy("l_orderkey").agg(
        F.sum(price).alias("gross_value"),
        F.sum(price * disc).alias("discount_value"),
        F.sum(net).alias("net_value"),
        F.sum(net * tax).alias("tax_value"),
        F.count(F.lit(1)).alias("n_lines"),
    )


ORDER_VALUES_SQL = """
order_values AS (
    SELECT l_orderkey,
           sum(l_extendedprice) AS gross_value,
           sum(l_extendedprice * l_discount) AS discount_value,
           sum(l_extendedprice * (1 - l_discount)) AS net_value,
           sum(l_extendedprice * (1 - l_discount) * l_tax) AS tax_value,
           count(*) AS n_lines
    FROM lineitem GROUP BY l_orderkey
)"""


def _band(balance) -> F.Column:
    out = None
    for edge, label in BALANCE_BANDS:
        out = F.when(balance < F.lit(edge), F.lit(label)) if out is None else out.when(balance < F.lit(edge), F.lit(label))
    return out.otherwise(F.lit("high"))


def _band_sql(expr: str) -> str:
    whens = " ".join(f"WHEN {expr} < {edge} THEN '{label}'" for edge, label in BALANCE_BANDS)
    return f"CASE {whens} ELSE 'high' END"


def unit_year(cat: Catalog, years: Sequence[int] | None = None) -> DataFrame:
    """The wide unit-year fact (the stand-in of the reference's mart).

    With ``years`` only those years are built, and the restriction is also
    written as a date range on ``o_orderdate`` so it reaches the Parquet scan
    as pushed filters (row groups outside the range are skipped); the exact
    year test stays for non-contiguous year lists.
    """
    o = cat["orders"]
    if years:
        t = o.schema["o_orderdate"].dataType
        start = F.lit(f"{min(years)}-01-01 00:00:00").cast(t)
        end = F.lit(f"{max(years) + 1}-01-01 00:00:00").cast(t)
        o = o.filter((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end)
                     & F.year("o_orderdate").isin(list(years)))
    o = o.select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"),
        "o_totalprice", "o_orderstatus", "o_orderpriority",
    )
    ov = order_values(cat)
    j = o.join(ov, o["o_orderkey"] == ov["l_orderkey"], "left")
    uy = j.groupBy("o_custkey", "year").agg(
        F.sum("o_totalprice").alias("market_value"),
        F.sum("net_value").alias("policy_value"),
        F.sum("gross_value").alias("gross_value"),
        F.sum("discount_value").alias("discount_value"),
        F.sum("tax_value").alias("tax_value"),
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.when(F.col("o_orderstatus") == FINISHED_STATUS, 1).otherwise(0)).cast("long").alias("n_full"),
        F.max(F.when(F.col("o_orderpriority") == URGENT_PRIORITY, 1).otherwise(0)).alias("own_input"),
        F.sum("n_lines").alias("n_lines"),
    )
    cust = cat["customer"].select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    nation = small_dim(cat["nation"].select("n_nationkey", "n_name", "n_regionkey"), max_rows=10_000)
    region = small_dim(cat["region"].select("r_regionkey", "r_name"), max_rows=10_000)
    f = (
        uy.join(cust, uy["o_custkey"] == cust["c_custkey"], "inner")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "inner")
    )
    return f.select(
        F.col("c_custkey").alias("unit_id"),
        F.col("n_name").alias("company"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("complex"),
        _band(F.col("c_acctbal")).alias("unit_type"),
        F.when(F.col("c_acctbal") < 0, F.lit("Other")).otherwise(F.lit("Residential")).alias("model"),
        "year",
        F.when(F.col("n_full") > 0, F.lit("Full")).otherwise(F.lit("Basis")).alias("valuation_type"),
        "own_input",
        "market_value", "policy_value", "gross_value", "discount_value", "tax_value",
        "n_orders", "n_full",
        (F.col("n_full") / F.col("n_orders")).alias("pct_full"),
        "n_lines",
        F.col("c_acctbal").alias("acctbal"),
    )


UNIT_YEAR_SQL = ORDER_VALUES_SQL + f""",
uy_agg AS (
    SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
           sum(o_totalprice) AS market_value,
           sum(net_value) AS policy_value,
           sum(gross_value) AS gross_value,
           sum(discount_value) AS discount_value,
           sum(tax_value) AS tax_value,
           count(*) AS n_orders,
           CAST(sum(CASE WHEN o_orderstatus = '{FINISHED_STATUS}' THEN 1 ELSE 0 END) AS BIGINT) AS n_full,
           max(CASE WHEN o_orderpriority = '{URGENT_PRIORITY}' THEN 1 ELSE 0 END) AS own_input,
           CAST(sum(n_lines) AS BIGINT) AS n_lines
    FROM orders LEFT JOIN order_values ON o_orderkey = l_orderkey
    GROUP BY o_custkey, CAST(year(o_orderdate) AS INTEGER)
),
unit_year AS (
    SELECT c_custkey AS unit_id, n_name AS company, r_name AS region,
           c_mktsegment AS complex,
           {_band_sql('c_acctbal')} AS unit_type,
           CASE WHEN c_acctbal < 0 THEN 'Other' ELSE 'Residential' END AS model,
           year,
           CASE WHEN n_full > 0 THEN 'Full' ELSE 'Basis' END AS valuation_type,
           own_input, market_value, policy_value, gross_value, discount_value, tax_value,
           n_orders, n_full, n_full / n_orders AS pct_full, n_lines, c_acctbal AS acctbal
    FROM uy_agg
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
)"""


def line_steps(cat: Catalog) -> DataFrame:
    """Net line value per (unit, company, region, step = part brand, year).

    Stand-in of the reference's step table (value per valuation step): the
    change of each brand's value between two years is a 'driver step'.
    """
    li = cat["lineitem"].select("l_orderkey", "l_partkey", (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("net"))
    o = cat["orders"].select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    part = cat["part"].select("p_partkey", "p_brand", "p_type")
    cust = cat["customer"].select("c_custkey", "c_nationkey")
    nation = small_dim(cat["nation"].select("n_nationkey", "n_name", "n_regionkey"), max_rows=10_000)
    region = small_dim(cat["region"].select("r_regionkey", "r_name"), max_rows=10_000)
    j = (
        li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )
    agg = j.groupBy("o_custkey", "year", "p_brand", "p_type").agg(F.sum("net").alias("value"))
    return (
        agg.join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("unit_id"), F.col("n_name").alias("company"),
            F.col("r_name").alias("region"), F.col("p_brand").alias("step"),
            F.col("p_type").alias("step_group"), "year", "value",
        )
    )


LINE_STEPS_SQL = """
line_steps AS (
    SELECT c_custkey AS unit_id, n_name AS company, r_name AS region,
           p_brand AS step, p_type AS step_group, year, value
    FROM (
        SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, p_brand, p_type,
               sum(l_extendedprice * (1 - l_discount)) AS value
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey
        GROUP BY 1, 2, 3, 4
    ) s
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
)"""


def with_sql(*ctes: str) -> str:
    """Join CTE bodies into one WITH prefix (callers append their SELECT)."""
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes) + "\n"
