"""Shared pieces of the registered queries: the fact, the panel and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import Bits
from ..plans.panel import prior_name, yoy_panel
from ..sources.standin import LINE_STEPS_SQL, UNIT_YEAR_SQL, line_steps, unit_year, with_sql
from ..sources.tables import MATERIALIZE_CONF, Catalog

# Fixed parameters of the stand-in analyses.
CUR, PREV = 2000, 1999
KEYS = ["unit_id", "company"]
PANEL_COLS = ["market_value", "policy_value", "discount_value", "valuation_type", "model", "region", "own_input",
              "unit_type", "complex", "pct_full", "n_orders", "tax_value", "acctbal"]

# Rounding of doubles for the oracle compare (see registry).  Sums of prices,
# net values and taxed values are exact decimals (2, 4, 6 places): they are
# rounded on a decimal grid finer than that, so no tie can come from the data.
# Means, ratios and other computed values go on a binary grid (no decimal
# midpoint ties), coarse enough that last-bit summation differences between
# engines practically never cross a grid line.
MONEY, NET, TAX = 4, 6, 8
MEAN, INDEX, RATIO = Bits(16), Bits(24), Bits(32)


def fact(cat: Catalog, years: list[int] | None = None) -> DataFrame:
    """The unit-year fact, optionally only some years.

    Materialised: one table partitioned by year (the filter prunes folders).
    Lazy: a years-restricted build whose date range is pushed into the scan.
    """
    if years is None or cat.spark.conf.get(MATERIALIZE_CONF, "false").lower() == "true":
        f = cat.model("unit_year", unit_year, partition_by=["year"], bucket_by=KEYS)
        return f if years is None else f.filter(F.col("year").isin(list(years)))
    ys = sorted(set(years))
    return cat.model("unit_year_" + "_".join(map(str, ys)), lambda c: unit_year(c, ys))


def steps(cat: Catalog) -> DataFrame:
    return cat.model("line_steps", line_steps)


def panel(cat: Catalog) -> DataFrame:
    return cat.model("panel", lambda c: yoy_panel(fact(c, [PREV, CUR]), KEYS, "year", CUR, PANEL_COLS))


def p(c: str) -> str:
    """Prior-year name of a panel column."""
    return prior_name(c, PREV)


def _panel_cte() -> str:
    prior = ", ".join(f"{c} AS {p(c)}" for c in PANEL_COLS)
    return f"""
panel AS (
    SELECT coalesce(y0.unit_id, ym1.unit_id) AS unit_id,
           coalesce(y0.company, ym1.company) AS company,
           y0.* EXCLUDE (unit_id, company),
           ym1.* EXCLUDE (unit_id, company),
           CASE WHEN y0.unit_id IS NOT NULL AND ym1.unit_id IS NOT NULL THEN 'both'
                WHEN y0.unit_id IS NOT NULL THEN 'left_only'
                ELSE 'right_only' END AS _merge
    FROM (SELECT * FROM unit_year WHERE year = {CUR}) y0
    FULL OUTER JOIN (SELECT unit_id, company, {prior} FROM unit_year WHERE year = {PREV}) ym1
      ON y0.unit_id = ym1.unit_id AND y0.company = ym1.company
)"""


UY = with_sql(UNIT_YEAR_SQL)
UY_PANEL = with_sql(UNIT_YEAR_SQL, _panel_cte())
STEPS = with_sql(LINE_STEPS_SQL)
UY_STEPS = with_sql(UNIT_YEAR_SQL, LINE_STEPS_SQL)
