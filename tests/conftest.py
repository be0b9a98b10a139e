import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from panelmart.session import local_session

    s = local_session(cores=4, shuffle_partitions=8, app="panelmart-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from panelmart.sources.tables import TABLES

    sf = os.environ.get("PANELMART_TEST_SF", "/root/testdata/sf0.001")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con
