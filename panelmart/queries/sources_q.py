"""Source and sink queries on files Spark writes from the test tables: A3–A5, A7–A9, A11–A17, A19, A23, A24, A27.

Every query first writes its raw input (CSV, JSON, text sections, GeoJSON,
report folders) from the given tables into a fresh folder below the shared
folder, then reads it with the operator under test, so its work grows with the
tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..registry import register
from ..sources import external as X
from ..sources import files as FL
from ..sources import nested as N
from ..sources import sinks as S
from ..sources.tables import shared_dir
from .common import MONEY


GROUP_KEYS = 10_000   # keys of one nested row or raw file: their number grows with the table, not their size


def _group(key: str):
    """Bucket of at most ``GROUP_KEYS`` distinct keys."""
    return F.floor(F.col(key) / GROUP_KEYS).cast("long")


def _folder(cat, name: str) -> str:
    return f"{shared_dir(cat.spark).rstrip('/')}/panelmart_raw/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- A3
@register("seed_exclusions", """
SELECT 'market_value' AS measure, s_name AS company, CAST(1992 + s_nationkey AS INTEGER) AS year FROM supplier""", ids=("A3",))
def q_seed_exclusions(cat):
    path = _folder(cat, "seed")
    cat["supplier"].select(F.lit("market_value").alias("measure"), F.col("s_name").alias("company"),
                           (F.col("s_nationkey") + 1992).alias("year")).write.option("header", True).csv(path)
    return FL.read_seed(cat.spark, path, "measure string, company string, year int")


# ---------------------------------------------------------------- A4 / A5
ROUNDS_SQL = """
flat AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS company_id, CAST(year(o_orderdate) AS BIGINT) AS valuation_round_id,
         CASE WHEN year(o_orderdate) % 2 = 0 THEN year(o_orderdate) || '-12-31' END AS issue_date, o_orderkey AS valuation_id,
         o_orderpriority AS valuation_name, o_orderstatus = 'F' AS archived, o_orderpriority = '1-URGENT' AS main_valuation,
         strftime(o_orderdate, '%Y-%m-%d') AS creation_date_time,
         CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE o_custkey + 1000000 END AS sub_portfolio_id
  FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL
  SELECT CAST(n_nationkey AS VARCHAR), 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM nation)
"""
_ROUND_COLS = ["company_id", "valuation_round_id", "issue_date", "valuation_id", "valuation_name", "archived", "main_valuation",
               "creation_date_time", "sub_portfolio_id"]


def _payload(cat):
    """JSON payloads of a company by order-key bucket; every company has the same round ids and one round without valuations."""
    year = F.year("o_orderdate")
    own = F.struct(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("id"),
                   F.when(F.col("o_orderkey") % 2 != 0, F.col("o_custkey") + 1_000_000).alias("subPortfolioId"))
    valuation = F.struct(F.col("o_orderkey").alias("valuationId"), F.col("o_orderpriority").alias("name"), (F.col("o_orderstatus") == "F").alias("archived"),
                         (F.col("o_orderpriority") == "1-URGENT").alias("mainValuation"),
                         F.date_format("o_orderdate", "yyyy-MM-dd").alias("creationDateTime"), own.alias("subPortfolio"))
    orders = cat["orders"].join(cat["customer"], F.col("o_custkey") == F.col("c_custkey"))
    rounds = orders.groupBy(F.col("c_nationkey").alias("k"), _group("o_orderkey").alias("bucket"), year.alias("id")).agg(F.collect_list(valuation).alias("valuations"))
    empty = cat["nation"].select(F.col("n_nationkey").alias("k"), F.lit(-1).cast("long").alias("bucket"), F.lit(0).alias("id"), F.lit(None).cast(rounds.schema["valuations"].dataType).alias("valuations"))
    quarter = F.when((F.col("id") % 2 == 0) & (F.col("id") > 0), "Q4").otherwise("Q2")
    one = F.struct(F.col("id").cast("long").alias("id"), F.struct(F.col("id").alias("year"), quarter.alias("quarter")).alias("issueDate"), "valuations")
    path = _folder(cat, "rounds")
    payloads = rounds.unionByName(empty).groupBy(F.col("k").cast("string").alias("company_id"), "bucket").agg(F.collect_list(one).alias("rounds"))
    payloads.drop("bucket").write.json(path)
    return cat.spark.read.json(path)


@register("rounds_flat", f"WITH {ROUNDS_SQL} SELECT * FROM flat", ids=("A4",))
def q_rounds_flat(cat):
    return N.flatten_rounds_json(_payload(cat)).select(*_ROUND_COLS)


@register("rounds_joined", f"WITH {ROUNDS_SQL} SELECT * FROM flat", ids=("A4",))
def q_rounds_joined(cat):
    r = _payload(cat).select("company_id", F.explode("rounds").alias("r")).select("company_id", "r.*")
    v = r.select("company_id", F.col("id").alias("round_id"), F.explode("valuations").alias("v")).select("company_id", "round_id", "v.*")
    return N.flatten_rounds(r.drop("valuations").distinct(), v).select(*_ROUND_COLS)


@register("rounds_main", f"WITH {ROUNDS_SQL} SELECT * FROM flat WHERE main_valuation AND NOT archived", ids=("A5",))
def q_rounds_main(cat):
    return N.main_valuations(N.flatten_rounds_json(_payload(cat))).select(*_ROUND_COLS)


# ---------------------------------------------------------------- A7
@register("split_branches", """
SELECT l_orderkey, l_linenumber, 'market' AS branch, l_extendedprice AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'policy', l_extendedprice * l_discount FROM lineitem""", digits={"value": MONEY}, ids=("A7",))
def q_split_branches(cat):
    raw = cat["lineitem"].select("l_orderkey", "l_linenumber", F.struct(
        F.struct(F.col("l_extendedprice").alias("value")).alias("market"),
        F.struct((F.col("l_extendedprice") * F.col("l_discount")).alias("value")).alias("policy")).alias("payload"))
    keys = ["l_orderkey", "l_linenumber"]
    parts = N.split_branches(raw, {"market": "payload.market", "policy": "payload.policy"}, keep=keys)
    return parts["market"].select(*keys, F.lit("market").alias("branch"), "value").unionByName(
        parts["policy"].select(*keys, F.lit("policy").alias("branch"), "value"))


# ---------------------------------------------------------------- A8 / A9
@register("unit_arrays", """
SELECT DISTINCT l_partkey AS internalId, CAST(l_partkey + 7 AS VARCHAR) AS unit_number,
       CASE WHEN l_partkey % 3 = 0 THEN 'V' ELSE 'C' END || l_partkey % 10 AS complex_code
FROM lineitem WHERE l_partkey % 5 <> 0""", ids=("A8",))
def q_unit_arrays(cat):
    k = F.col("l_partkey")
    unit = F.struct(F.when(k % 5 != 0, k).alias("internalId"), F.when(k % 2 == 0, (k + 7).cast("string")).alias("rentalUnitNumber"),
                    F.when(k % 2 != 0, (k + 7).cast("string")).alias("unitNumber"),
                    F.when(k % 3 == 0, F.concat(F.lit("V"), (k % 10).cast("string"))).otherwise("").alias("valuationComplexCode"),
                    F.concat(F.lit("C"), (k % 10).cast("string")).alias("complexCode"))
    nested = cat["lineitem"].groupBy("l_orderkey").agg(
        F.collect_list(F.when(F.col("l_linenumber") % 2 == 0, unit)).alias("residential"),
        F.collect_list(F.when(F.col("l_linenumber") % 2 != 0, unit)).alias("parking"))
    return N.union_unit_arrays(nested, ["residential", "parking"], "internalId", ["rentalUnitNumber", "unitNumber"], ["internalId", "unit_number"],
                               {"complex_code": ["valuationComplexCode", "complexCode"]}).select("internalId", "unit_number", "complex_code")


@register("sub_entity_names", """
SELECT DISTINCT c_mktsegment AS name FROM customer WHERE c_mktsegment IS NOT NULL AND trim(c_mktsegment) <> ''""", ids=("A9",))
def q_sub_entity_names(cat):
    padded = F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))
    nested = cat["customer"].groupBy(_group("c_custkey")).agg(F.collect_list(F.struct(padded.alias("label"))).alias("subs"))
    return N.distinct_names(nested, "subs", "label")


# ---------------------------------------------------------------- A11–A15
REPORT_SQL = """
r AS (SELECT o_orderkey AS unit_no, o_totalprice AS value, CAST(o_orderkey % 4 AS INTEGER) AS book FROM orders)
"""
_REPORT = T.StructType([T.StructField("Unit no.", T.LongType()), T.StructField("Value %", T.DoubleType())])


def _report_books(cat) -> tuple[str, object]:
    """Books of one sheet with two title lines; header order differs between files, one book has no matching rows."""
    root = _folder(cat, "books")
    o = cat["orders"].select("o_orderkey", F.round("o_totalprice", 2).alias("v"), (F.col("o_orderkey") % 4).cast("int").alias("book"),
                             _group("o_orderkey").alias("sheet"))
    line = F.when(F.col("book") % 2 == 0, F.concat_ws(",", "o_orderkey", F.concat(F.lit('"'), F.col("v").cast("string"), F.lit('"')))).otherwise(
        F.concat_ws(",", F.col("v").cast("string"), "o_orderkey"))
    head = F.when(F.col("book") % 2 == 0, "Unit no.,Value %").otherwise("Value %,Unit no.")
    files = o.groupBy("book", "sheet").agg(F.array_join(F.flatten(F.array(F.array(F.lit("A title"), F.lit("a subtitle"), F.first(head)), F.collect_list(line))), "\n").alias("value"))
    files.write.partitionBy("book", "sheet").option("lineSep", "\n").text(root)
    return root, None


@register("report_manifest", f"WITH {REPORT_SQL} SELECT unit_no, value, book AS company, CAST(2000 + book AS INTEGER) AS year FROM r",
          digits={"value": MONEY}, ids=("A11", "A13", "A14", "A15"))
def q_report_manifest(cat):
    root, _ = _report_books(cat)
    manifest = FL.file_manifest(cat.spark, root, "part-*").withColumn("company", F.regexp_extract("path", r"book=(\d+)", 1).cast("int"))
    manifest = manifest.select("path", "company", (F.col("company") + 2000).cast("int").alias("year"))
    rows = FL.read_manifest(cat.spark, manifest, skip_rows=2, schema=_REPORT)
    return rows.select(F.col("`Unit no.`").alias("unit_no"), F.col("`Value %`").alias("value"), "company", "year")


@register("report_records", """
SELECT c_custkey AS k, 'first line' || chr(10) || c_name || ', "' || c_mktsegment || '"' AS note, CAST(c_nationkey AS VARCHAR) AS code, c_mktsegment AS code_again
FROM customer""", ids=("A13",))
def q_report_records(cat):
    """Cells with line breaks, commas and quotes under a title of two lines and a repeated header name."""
    root = _folder(cat, "records")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    note = F.concat(F.lit("first line\n"), "c_name", F.lit(', "'), "c_mktsegment", F.lit('"'))
    record = F.concat_ws(",", "c_custkey", quoted(note), "c_nationkey", "c_mktsegment")
    lines = cat["customer"].groupBy(_group("c_custkey").alias("part")).agg(F.collect_list(record).alias("l"))
    head = F.array(F.lit('"A title\nof two lines"'), F.lit("a subtitle"), F.lit("k,note,code,code"))
    lines.select("part", F.array_join(F.concat(head, "l"), "\n").alias("value")).write.partitionBy("part").text(root)
    schema = T.StructType([T.StructField("k", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("note", "code", "code.1"))])
    return FL.read_sheet(cat.spark, root, schema=schema, skip_rows=2).select("k", "note", "code", F.col("`code.1`").alias("code_again"))


@register("report_sheets", """
SELECT c_custkey AS k, 'units' AS output FROM customer UNION ALL SELECT s_suppkey, 'other' FROM supplier""", ids=("A11", "A12"))
def q_report_sheets(cat):
    root = _folder(cat, "sheets")
    cat["customer"].select(F.col("c_custkey").alias("k")).write.option("header", True).csv(f"{root}/Units Overview")
    cat["supplier"].select(F.col("s_suppkey").alias("k")).write.option("header", True).csv(f"{root}/A first sheet")
    cat["customer"].limit(0).select(F.col("c_custkey").alias("k")).write.option("header", True).csv(f"{root}/Other")
    schema = T.StructType([T.StructField("k", T.LongType())])
    out = FL.read_report(cat.spark, root, {"units": ["units overview"]}, schemas={"units": schema})
    out |= FL.read_report(cat.spark, root, {"other": ["other"]}, schemas={"other": schema}, default_first=True)   # no rows: first sheet
    return X.stack_sheets(out, "output")


# ---------------------------------------------------------------- A16 / A17
@register("existing_files", "SELECT DISTINCT CAST(c_nationkey AS INTEGER) AS company FROM customer", ids=("A15", "A16"))
def q_existing_files(cat):
    root = _folder(cat, "json")
    cat["customer"].select("c_nationkey", "c_custkey").repartition("c_nationkey").write.partitionBy("c_nationkey").json(root)
    files = FL.file_manifest(cat.spark, root, "part-*").select("path")
    wanted = files.unionByName(files.select(F.concat("path", F.lit(".missing")).alias("path")))
    FL.require_root(cat.spark, root, "object")
    found = FL.existing_only(cat.spark, wanted, root)
    return found.select(F.regexp_extract("path", r"c_nationkey=(\d+)", 1).cast("int").alias("company")).distinct()


@register("round_metadata", """
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS company_id, CAST(year(o_orderdate) AS BIGINT) AS valuation_round_id,
       CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE year(o_orderdate) || '-12-31' END AS issue_date,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey END AS round_data_set_id
FROM orders""", ids=("A17",))
def q_round_metadata(cat):
    year = F.year("o_orderdate")
    flat = cat["orders"].select(
        F.col("o_custkey").cast("string").alias("company_id"), year.cast("long").alias("valuation_round_id"), year.cast("long").alias("issue_year"),
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(" ").alias("issue_date"),
        F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderkey").cast("string")).alias("data_set_id"),
        F.lit(5).cast("long").alias("round_data_set_id"))
    return FL.round_metadata(flat)


# ---------------------------------------------------------------- A19 / A23
@register("section_lines", """
SELECT CAST(c_custkey AS VARCHAR) AS code, 'area' || c_nationkey AS area, CASE WHEN c_custkey % 3 = 0 THEN 'idx' END AS index_area,
       c_mktsegment AS label
FROM customer WHERE c_custkey % 7 <> 0""", ids=("A19",))
def q_section_lines(cat):
    k = F.col("c_custkey")
    area = F.concat(F.lit("area"), F.col("c_nationkey").cast("string"))
    line = (F.when(k % 7 == 0, F.concat(k.cast("string"), F.lit(" short")))
            .when(k % 3 == 0, F.concat_ws("  ", k.cast("string"), area, F.lit("idx"), "c_mktsegment"))
            .otherwise(F.concat_ws("\t", k.cast("string"), area, "c_mktsegment")))
    line = F.when((k % 6 == 0) & (k % 7 != 0), F.concat(line, F.lit(" one more"))).otherwise(line)
    text = cat["customer"].groupBy(_group("c_custkey").alias("bucket")).agg(F.array_join(F.flatten(F.array(
        F.array(F.lit("[Other]"), F.lit("x y z"), F.lit("[Codes]"), F.lit("# a comment"), F.lit("Code  Area Label")), F.collect_list(line),
        F.array(F.lit(""), F.lit("Checksum 12"), F.lit("[Tail]"), F.lit("1 2 3 4")))), "\n").alias("value"))
    path = _folder(cat, "sections")
    text.write.partitionBy("bucket").text(path)
    return X.read_sections(cat.spark, path, "Codes", [(4, {"code": 0, "area": 1, "index_area": 2, "label": 3}), (3, {"code": 0, "area": 1, "label": 2})],
                           header_prefix="Code").select("code", "area", "index_area", "label")


@register("geojson_features", """
SELECT s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR) END AS code, NULL::VARCHAR AS absent,
       CASE WHEN s_suppkey % 3 <> 0 THEN 'Point' END AS geometry_type
FROM supplier""", ids=("A23",))
def q_geojson_features(cat):
    k = F.col("s_suppkey")
    feature = F.struct(F.struct(F.col("s_name").alias("name"), F.when(k % 2 == 0, F.col("s_nationkey").cast("string")).alias("code")).alias("properties"),
                       F.when(k % 3 != 0, F.struct(F.lit("Point").alias("type"), F.array(k.cast("double"), F.lit(1.5)).alias("coordinates"))).alias("geometry"))
    path = _folder(cat, "geo")
    cat["supplier"].groupBy(_group("s_suppkey").alias("bucket")).agg(F.collect_list(feature).alias("features")).withColumn("type", F.lit("FeatureCollection")).write.partitionBy("bucket").json(path)
    return X.read_geojson(cat.spark, path, ["name", "code", "absent"]).select("name", "code", "absent", "geometry_type")


# ---------------------------------------------------------------- A24 / A27
@register("partition_replace", """
SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN -1.0 ELSE c_acctbal END AS acctbal, c_nationkey AS company FROM customer""",
          digits={"acctbal": MONEY}, ids=("A24",))
def q_partition_replace(cat):
    path = _folder(cat, "replace")
    rows = cat["customer"].select("c_custkey", F.col("c_acctbal").alias("acctbal"), F.col("c_nationkey").alias("company"))
    S.replace_partitions(rows, path, ["company"])
    S.replace_partitions(rows.filter(F.col("company") == 3).withColumn("acctbal", F.lit(-1.0)), path, ["company"])
    return cat.spark.read.schema(rows.schema).parquet(path)


@register("export_pair", """
SELECT c_nationkey AS company, count(*) AS n, 'summary' AS part FROM customer GROUP BY 1
UNION ALL SELECT c_nationkey, c_custkey, 'detail' FROM customer""", ids=("A27",))
def q_export_pair(cat):
    detail = cat["customer"].select(F.col("c_nationkey").alias("company"), F.col("c_custkey").alias("n"))
    d, s = S.export_pair(detail, detail.groupBy("company").agg(F.count(F.lit(1)).alias("n")), _folder(cat, "export"))
    return cat.spark.read.parquet(s).withColumn("part", F.lit("summary")).unionByName(cat.spark.read.parquet(d).withColumn("part", F.lit("detail")))
