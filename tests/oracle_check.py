"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [SF_DIR] [name ...]
Mimics the driver's gate: row count, column names, order-free value equality.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from panelmart.session import local_session  # noqa: E402
from panelmart.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NA or v is pd.NaT:
            return None
    except Exception:
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(df):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False):
        out.append(tuple(norm(v) for v in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as E

    spark = local_session(8, int(os.environ.get("PANELMART_SHUFFLE_PARTITIONS", "8")))
    if os.environ.get("PANELMART_PERCENTILES"):
        spark.conf.set("spark.panelmart.percentiles", os.environ["PANELMART_PERCENTILES"])
    if os.environ.get("PANELMART_MATERIALIZE"):
        spark.conf.set("spark.panelmart.materialize", "true")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(sdf)} rows (no oracle) {ts:.2f}s")
            continue
        try:
            odf = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sc, sr = rows_of(sdf)
        oc, orr = rows_of(odf)
        if sc != oc:
            print(f"FAIL {name}: columns differ\n  spark={sc}\n  duck ={oc}")
            bad += 1
            continue
        if len(sr) != len(orr):
            print(f"FAIL {name}: rows spark={len(sr)} duck={len(orr)}")
            bad += 1
            continue
        diffs = [(a, b) for a, b in zip(sr, orr) if a != b]
        if diffs:
            print(f"FAIL {name}: {len(diffs)} differing rows of {len(sr)}; cols={sc}")
            for a, b in diffs[:3]:
                print("   spark:", a)
                print("   duck :", b)
            bad += 1
            continue
        print(f"OK   {name}: {len(sr)} rows {ts:.2f}s")
    print(f"{bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
