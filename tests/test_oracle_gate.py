"""Every registered query agrees with its DuckDB oracle (the driver's gate, on a small SF)."""

import math
import os

import pandas as pd
import pytest

import __spark_entry__ as E
from panelmart.registry import REGISTRY

SF = os.environ.get("PANELMART_TEST_SF", "/root/testdata/sf0.001")
QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def test_every_query_has_an_oracle_or_is_listed():
    missing = sorted(set(REGISTRY) - set(ORACLE))
    assert missing == [], f"queries without oracle SQL: {missing}"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "value_kind" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.execute(ORACLE[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


MEDIAN_QUERIES = ["with_totals_median", "region_change", "median_forms", "kpi_summary", "box_stats",
                  "trend_lines", "realised_expected", "median_value_excl"]


@pytest.mark.parametrize("name", MEDIAN_QUERIES)
def test_median_queries_bracketed_path(spark, duck, name):
    """The bounded percentile plan gives the oracle's exact medians too."""
    spark.conf.set("spark.panelmart.percentiles", "bracketed")
    try:
        got = QUERIES[name](spark, SF).toPandas()
    finally:
        spark.conf.unset("spark.panelmart.percentiles")
    want = duck.execute(ORACLE[name]).df()
    assert _rows(got) == _rows(want)
