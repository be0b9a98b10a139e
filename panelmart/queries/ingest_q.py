"""Schema, cleaning and ingest queries on the test tables: B1–B10, A6, A10, A18, A20, A22, A26."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import conform as C
from ..registry import register
from ..sources import external as X
from ..sources import files as FL
from ..sources import nested as N
from ..sources import sinks as S
from .common import CUR, MONEY, PREV, UY, fact


# ---------------------------------------------------------------- B3 / B8
@register("coerce_numeric", r"""
SELECT event_id, lpad(CAST(event_id AS VARCHAR), 8, '0') AS event_code, event_type,
       TRY_CAST(regexp_extract(props, ':\s*(\d+)', 1) AS DOUBLE) AS json_k,
       TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value_text
FROM events""", digits={"value_text": MONEY}, ids=("B3", "B8", "H10"))
def q_coerce_numeric(cat):
    e = cat["events"].select(
        "event_id", F.lpad(F.col("event_id").cast("string"), 8, "0").alias("event_code"), "event_type",
        F.regexp_extract("props", r":\s*(\d+)", 1).alias("json_k"), F.col("value").cast("string").alias("value_text"))
    return C.coerce_numeric(e, protected=["event_code"])


# ---------------------------------------------------------------- B4
@register("concat_frames", f"""
SELECT o_orderkey, TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS value, NULL::VARCHAR AS o_orderpriority
FROM orders WHERE year(o_orderdate) = {PREV}
UNION ALL
SELECT o_orderkey, TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS value, o_orderpriority
FROM orders WHERE year(o_orderdate) = {CUR}""", digits={"value": MONEY}, ids=("B4", "H4"))
def q_concat_frames(cat):
    o = cat["orders"]
    a = o.filter(F.year("o_orderdate") == PREV).select("o_orderkey", F.col("o_totalprice").cast("string").alias("value"))
    b = o.filter(F.year("o_orderdate") == CUR).select("o_orderkey", F.col("o_totalprice").cast("string").alias("value"),
                                                       "o_orderpriority")
    return C.concat_frames([a, b])


# ---------------------------------------------------------------- B1 / B2 / B5 / B6
CONTRACT = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value_pct", T.DoubleType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("session", T.StringType()),
])


@register("conform_schema", """
SELECT event_id, user_id, event_type, value AS value_pct, ts, CAST(NULL AS VARCHAR) AS session FROM events""",
          digits={"value_pct": MONEY}, ids=("B1", "B2", "B5", "B6", "B7"))
def q_conform_schema(cat):
    raw = cat["events"].select(F.col("event_id").alias("eventId"), F.col("user_id").alias("userId"),
                               F.col("event_type").alias("Event Type"), F.col("value").alias("Value %"), "ts", "props")
    named = C.normalize_column_names(raw, types={"user_id": "int", "event_type": "str"})
    known, _dropped = C.drop_unknown(named, CONTRACT.fieldNames())   # B7: 'props' is not in the contract
    return C.validate(known, CONTRACT)


# ---------------------------------------------------------------- A6 / H15
@register("json_flatten", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS "props.k" FROM events""", ids=("A6", "H15"))
def q_json_flatten(cat):
    return N.parse_json_column(cat["events"], "props", "k INT", keep=["event_id"])


# ---------------------------------------------------------------- B9
@register("dedupe_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""", ids=("B9",))
def q_dedupe_first(cat):
    li = cat["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    out = C.dedupe_first(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return out.drop("l_extendedprice")


# ---------------------------------------------------------------- B10
@register("entity_coverage", UY + f"""
, e AS (SELECT DISTINCT n_name AS company, true AS expected FROM nation),
f AS (SELECT DISTINCT company, true AS found FROM unit_year WHERE year = {CUR} AND n_orders >= 4),
a AS (SELECT DISTINCT company, true AS active FROM unit_year WHERE year = {PREV} AND n_orders >= 4),
j AS (SELECT coalesce(e.company, f.company, a.company) AS company,
             coalesce(expected, false) AS expected, coalesce(found, false) AS found, coalesce(active, false) AS active
      FROM e FULL OUTER JOIN f ON e.company = f.company
      FULL OUTER JOIN a ON coalesce(e.company, f.company) = a.company)
SELECT *, CASE WHEN expected AND found AND active THEN 'ok'
               WHEN expected AND NOT found THEN 'missing'
               WHEN expected THEN 'inactive'
               WHEN found AND active THEN 'unexpected'
               WHEN found THEN 'ignored' ELSE 'other' END AS category
FROM j""", ids=("B10",))
def q_entity_coverage(cat):
    f = fact(cat, [CUR, PREV])
    expected = cat["nation"].select(F.col("n_name").alias("company"))
    found = f.filter((F.col("year") == CUR) & (F.col("n_orders") >= 4)).select("company")
    active = f.filter((F.col("year") == PREV) & (F.col("n_orders") >= 4)).select("company")
    return C.entity_coverage(expected, found, active, "company")


# ---------------------------------------------------------------- A10
@register("pivot_levels", """
WITH r AS (SELECT l_orderkey, l_linestatus, sum(l_quantity) AS qty, count(*) AS n FROM lineitem GROUP BY 1, 2),
o AS (SELECT l_orderkey, qty AS qty_O, n AS n_O FROM r WHERE l_linestatus = 'O'),
f AS (SELECT l_orderkey, qty AS qty_F, n AS n_F FROM r WHERE l_linestatus = 'F')
SELECT coalesce(o.l_orderkey, f.l_orderkey) AS l_orderkey, qty_O, n_O, qty_F, n_F
FROM o FULL OUTER JOIN f ON o.l_orderkey = f.l_orderkey""", ids=("A10",))
def q_pivot_levels(cat):
    r = cat["lineitem"].groupBy("l_orderkey", "l_linestatus").agg(F.sum("l_quantity").alias("qty"),
                                                                   F.count(F.lit(1)).alias("n"))
    return N.pivot_levels(r, ["l_orderkey"], "l_linestatus", ("O", "F"), ["qty", "n"])


# ---------------------------------------------------------------- A20
@register("region_table", """
SELECT n_nationkey AS nation_code, trim(n_name) AS nation_name, n_regionkey AS region_code FROM nation""",
          ids=("A20",))
def q_region_table(cat):
    return X.region_table(cat["nation"], {"n_nationkey": "nation_code", "n_name": "nation_name",
                                          "n_regionkey": "region_code"})


# ---------------------------------------------------------------- A22 / H4
@register("stack_sheets", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment,
       'customer' AS _sheet FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier""",
          digits={"acctbal": MONEY}, ids=("A22", "H4"))
def q_stack_sheets(cat):
    c = cat["customer"].select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                               F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
                               F.col("c_mktsegment").alias("segment"))
    s = cat["supplier"].select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                               F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return X.stack_sheets({"customer": c, "supplier": s})


# ---------------------------------------------------------------- A18
@register("latest_dataset", """
SELECT n_name AS company, CAST(year(o_orderdate) AS INTEGER) AS year,
       coalesce(max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END), max(o_orderkey)) AS dataset_id,
       strftime(make_date(CAST(year(o_orderdate) AS INTEGER), 12, 31), '%Y-%m-%d') AS as_of
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1, 2""", ids=("A18", "H13"))
def q_latest_dataset(cat):
    o = cat["orders"].select("o_orderkey", "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("year"))
    c = cat["customer"].select("c_custkey", "c_nationkey")
    n = cat["nation"].select("n_nationkey", F.col("n_name").alias("company"))
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    j = j.withColumn("given_id", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderkey")))
    from ..functions.columns import as_of

    return FL.latest_dataset(j, ["company", "year"], "given_id", "o_orderkey").withColumn(
        "as_of", F.date_format(as_of("year"), "yyyy-MM-dd"))


# ---------------------------------------------------------------- A26
@register("load_stats", """
SELECT count(*) AS n_rows, 11 AS n_columns, count(DISTINCT l_orderkey) AS n_keys FROM lineitem""", ids=("A26",))
def q_load_stats(cat):
    return S.load_stats(cat["lineitem"], "l_orderkey")
