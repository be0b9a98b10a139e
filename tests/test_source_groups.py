"""Raw inputs of the source queries: nested rows and files have a bounded size, results stay."""

import pytest
from pyspark.sql import functions as F
from test_oracle_gate import ORACLE, QUERIES, SF, _rows

from panelmart.queries import sources_q as Q
from panelmart.sources.tables import Catalog

NAMES = ["report_manifest", "rounds_flat", "rounds_joined", "rounds_main", "section_lines", "geojson_features", "sub_entity_names"]


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(Q, "GROUP_KEYS", 200)


@pytest.mark.parametrize("name", NAMES)
def test_results_of_many_groups(spark, duck, few, name):
    assert _rows(QUERIES[name](spark, SF).toPandas()) == _rows(duck.execute(ORACLE[name]).df())


def test_groups_are_bounded(spark, few):
    cat = Catalog(spark, SF)
    sizes = Q._payload(cat).select(F.expr("aggregate(rounds, 0, (a, r) -> a + coalesce(size(r.valuations), 0))").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 200 and sizes.agg(F.sum("n")).first()[0] == cat["orders"].count()
    files = spark.read.text(Q._report_books(cat)[0], wholetext=True).select(F.size(F.split("value", "\n")).alias("n"))
    assert files.agg(F.max("n")).first()[0] <= 200 + 4 and files.count() > 4
