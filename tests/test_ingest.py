"""Ingest, schema and sink operators on small generated files (FIXTURES §1, §4)."""

import json
import os

import pytest
from support import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmart.operators import conform as C
from panelmart.sources import external as X
from panelmart.sources import files as FL
from panelmart.sources import nested as N
from panelmart.sources import sinks as S


# ---------------------------------------------------------------- B1 / B2
def test_normalize_column_names_and_types(spark):
    df = spark.createDataFrame([("2024", "12.5", "0123", "x", "nan")],
                               ["issueYear", "% Full", "post-code", "colA", "col_a"])
    out = C.normalize_column_names(df, renames={"issue_year": "year"}, types={"year": "int", "pct_full": "float"})
    assert out.columns == ["year", "pct_full", "post_code", "col_a"]  # later duplicate dropped
    r = out.first()
    assert (r.year, r.pct_full, r.post_code, r.col_a) == (2024, 12.5, "0123", "x")


def test_enforce_types_bad_values(spark):
    df = spark.createDataFrame([("20x4", "None"), ("2023", "ok")], ["year", "name"])
    out = C.enforce_column_types(df, {"year": "int", "name": "str"}).collect()
    assert [(r.year, r.name) for r in out] == [(None, None), (2023, "ok")]


# ---------------------------------------------------------------- B3 / B4 / B8
def test_coerce_numeric_threshold_and_protection(spark):
    df = spark.createDataFrame(
        [("1", "0012", "1", "a", "1"), ("2", "0013", "2", "b", "2"), ("3", "0014", "3", "c", "3"), (None, None, "x", "4", "y")],
        ["value", "unit_no", "Bron x", "mostly_text", "three_of_four"])
    out = C.coerce_numeric(df, protected=["unit_no"], prefixes=["Bron "])
    types = dict(out.dtypes)
    assert types["value"] == "double"
    assert types["unit_no"] == "string"       # identifier keeps leading zeroes
    assert types["Bron x"] == "string"
    assert types["mostly_text"] == "string"   # 1 of 4 numeric
    assert types["three_of_four"] == "double"  # 3 of 4 numeric (>= 50 %)


def test_concat_frames_recoerce_and_empty(spark):
    a = spark.createDataFrame([(1.0,)], "value double").select(F.col("value").cast("string").alias("value"))
    b = spark.createDataFrame([("2.5", "x")], "value string, extra string")
    out = C.concat_frames([a, b])
    assert dict(out.dtypes)["value"] == "double"
    assert out.count() == 2
    assert C.concat_frames([], spark=spark).count() == 0


# ---------------------------------------------------------------- B5 / B6 / B7
def test_validate_collects_all_errors(spark):
    schema = T.StructType([T.StructField("name", T.StringType(), False), T.StructField("value", T.DoubleType())])
    ok = C.validate(spark.createDataFrame([("a", "1.5")], "name string, value string"), schema)
    assert ok.dtypes == [("name", "string"), ("value", "double")]
    with pytest.raises(C.SchemaError) as e:
        C.validate(spark.createDataFrame([(None, "x"), ("b", "y")], "name string, value string"), schema)
    assert "'name': 1" in str(e.value) and "'value': 2" in str(e.value)
    empty = C.validate(spark.createDataFrame([], T.StructType([])), schema)
    assert empty.columns == ["name", "value"] and empty.count() == 0


def test_align_and_drop_unknown(spark):
    contract = T.StructType([T.StructField("depot", T.StringType()), T.StructField("opened", T.DateType()),
                             T.StructField("litres", T.DoubleType())])
    df = spark.createDataFrame([(7, "north"), (8, None)], "pump int, depot string")
    assert C.align(df, contract).columns == ["depot", "opened", "litres"]
    wide = C.align(df, contract, keep_extra=True)
    assert wide.columns == ["depot", "opened", "litres", "pump"]
    assert [tuple(r) for r in wide.orderBy("pump").collect()] == [("north", None, None, 7), (None, None, None, 8)]
    kept, dropped = C.drop_unknown(df, ["depot"])
    assert kept.columns == ["depot"] and dropped == ["pump"]


# ---------------------------------------------------------------- A4 / A5 / A17
def _rounds_payload(tmp_path):
    payload = [
        {"company_id": "c1", "rounds": [
            {"id": 1, "dataSetId": 11, "issueDate": {"year": 2024, "quarter": "Q4"}, "status": "DONE", "isFree": False,
             "valuations": [
                 {"valuationId": 100, "name": "main", "dataSetId": 11, "modelYear": 2024, "archived": False,
                  "mainValuation": True, "subPortfolio": {"id": 7, "name": "sp", "valuationLevel": "FULL"}},
                 {"valuationId": 101, "name": "old", "dataSetId": 11, "modelYear": 2024, "archived": True,
                  "mainValuation": False, "subPortfolio": None}]},
            {"id": 2, "dataSetId": 12, "issueDate": {"year": 2023, "quarter": "Q2"}, "status": "DONE", "isFree": True,
             "valuations": []},
        ]},
    ]
    p = tmp_path / "rounds.json"
    p.write_text(json.dumps(payload))
    return str(p)


def test_flatten_rounds(spark, tmp_path):
    raw = spark.read.option("multiLine", True).json(_rounds_payload(tmp_path))
    flat = N.flatten_rounds_json(raw)
    got = sorted((r.valuation_round_id, r.valuation_id, r.issue_date, r.sub_portfolio_id) for r in flat.collect())
    assert got == [(1, 100, "2024-12-31", 7), (1, 101, "2024-12-31", None), (2, None, None, None)]
    main = N.main_valuations(flat)
    assert [r.valuation_id for r in main.collect()] == [100]
    meta = FL.round_metadata(flat)
    assert meta.count() == 2
    assert FL.round_metadata(spark.createDataFrame([(1,)], "depot long")).count() == 0


def test_rounds_of_two_companies_stay_apart(spark):
    """Round ids are only unique within a company."""
    raw = spark.createDataFrame([("a", [(1, [(10,)])]), ("b", [(1, [(20,)]), (2, None)])],
                                "company_id string, rounds array<struct<id: long, valuations: array<struct<valuationId: long>>>>")
    want = [("a", 1, 10), ("b", 1, 20), ("b", 2, None)]
    assert sorted((r.company_id, r.valuation_round_id, r.valuation_id) for r in N.flatten_rounds_json(raw).collect()) == want
    r = raw.select("company_id", F.explode("rounds").alias("r")).select("company_id", "r.*")
    v = r.select("company_id", F.col("id").alias("round_id"), F.explode("valuations").alias("v")).select("company_id", "round_id", "v.*")
    joined = N.flatten_rounds(r.drop("valuations"), v)
    assert sorted((x.company_id, x.valuation_round_id, x.valuation_id) for x in joined.collect()) == want
    assert {"archived_date_time", "avm_issue_date", "has_changed_parameters", "is_new_calculation_rules"} <= set(joined.columns)


def test_round_metadata_blank_date_and_data_set(spark):
    df = spark.createDataFrame([("a", 1, 2024, " ", "9", 5), ("a", 2, 2023, "2023-06-30", "", 5), ("a", 2, 2023, "2023-06-30", "nan", 5)],
                               "company_id string, valuation_round_id long, issue_year long, issue_date string, data_set_id string, round_data_set_id long")
    got = sorted(tuple(r) for r in FL.round_metadata(df).collect())
    assert got == [("a", 1, "2024-12-31", 9), ("a", 2, "2023-06-30", None)]


def test_headers_of_every_file(spark, tmp_path):
    for name, lines in {"a.csv": ["title", "id,net value %,name", '1,"2.5",x'], "b.csv": ["title", "name,id", '"y, z",2']}.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    out = FL.read_sheet(spark, str(tmp_path), skip_rows=1)
    got = sorted((r["id"], r["name"], r["net value %"]) for r in out.collect())
    assert got == [("1", "x", "2.5"), ("2", "y, z", None)]


def test_records_with_line_breaks_and_repeated_headers(spark, tmp_path):
    """Records are skipped and parsed, not lines; repeated header names are told apart."""
    (tmp_path / "a.csv").write_text('"a title\nof two lines"\n\nid,note,note, note ,\n1,"two\nlines","say ""x, y""",z,w\r\n\n2,,"\n",\n')
    (tmp_path / "b.csv").write_text("title\nsubtitle\nnote,id\nlast,3")
    out = FL.read_sheet(spark, str(tmp_path), skip_rows=2)
    got = sorted((r["id"], r["note"], r["note.1"], r["note.2"]) for r in out.collect())
    assert got == [("1", "two\nlines", 'say "x, y"', "z"), ("2", None, "\n", None), ("3", "last", None, None)]
    (tmp_path / "open").mkdir()
    (tmp_path / "open" / "c.csv").write_text('t\nid,note\n4,"never closed\n5,x')
    assert [(r["id"], r["note"]) for r in FL.read_sheet(spark, str(tmp_path / "open"), skip_rows=1).collect()] == [("4", "never closed\n5,x")]


def test_numbers_in_text(spark):
    df = spark.createDataFrame([("12D", "1", "1.7"), ("3f", "nan", "2"), ("4", "2", " 3 "), ("5x", "None", "1e3")], "code string, mostly string, whole string")
    out = C.coerce_numeric(df)
    assert dict(out.dtypes) == {"code": "string", "mostly": "double", "whole": "double"}   # only one code is a number
    assert [r.mostly for r in out.collect()] == [1.0, None, 2.0, None]
    ints = C.enforce_column_types(df.select("whole"), {"whole": "int"})
    assert [r.whole for r in ints.collect()] == [None, 2, 3, 1000]


def test_json_root_type(spark, tmp_path):
    (tmp_path / "a.json").write_text('\n {"x": 1}')
    assert FL.require_root(spark, str(tmp_path)).count() == 1
    (tmp_path / "b.json").write_text("[1]")
    with pytest.raises(ValueError, match="b.json"):
        FL.require_root(spark, str(tmp_path))


def test_main_valuations_fails_when_empty(spark):
    df = spark.createDataFrame([(1, True, True)], "valuation_id long, main_valuation boolean, archived boolean")
    with pytest.raises(ValueError):
        N.main_valuations(df)


# ---------------------------------------------------------------- A6 / A7 / A8 / A9 / A10
def test_flatten_nested_and_branches(spark):
    df = spark.createDataFrame(
        [("c1", {"market": {"value": 1.0, "explain": ["a", "b"]}, "policy": {"value": 2.0, "explain": []}})],
        "company string, payload struct<market: struct<value: double, explain: array<string>>, policy: struct<value: double, explain: array<string>>>")
    flat = N.flatten(df, keep=["company"])
    assert flat.columns == ["company", "payload.market.value", "payload.market.explain",
                            "payload.policy.value", "payload.policy.explain"]
    assert flat.first()["payload.market.explain"] == '["a","b"]'
    parts = N.split_branches(df, {"market": "payload.market", "policy": "payload.policy"}, keep=["company"])
    assert parts["market"].columns == ["company", "value", "explain"]


def test_union_arrays_and_distinct_names(spark):
    df = spark.createDataFrame(
        [([{"id": 1, "number": "A", "alt": None}], [{"id": 1, "number": None, "alt": "A"}, {"id": None, "number": "B", "alt": None}],
          [" x ", "", "x", None])],
        "houses array<struct<id: long, number: string, alt: string>>, garages array<struct<id: long, number: string, alt: string>>, subs array<string>")
    units = N.union_unit_arrays(df, ["houses", "garages"], "id", ("number", "alt"), ["id", "unit_number"])
    assert [(r.id, r.unit_number) for r in units.collect()] == [(1, "A")]
    assert [r.name for r in N.distinct_names(df, "subs").collect()] == ["x"]


def test_pivot_levels(spark):
    df = spark.createDataFrame([(1, "L1", 5.0), (1, "L2", 6.0), (2, "L1", 7.0)], "k int, level string, v double")
    out = N.pivot_levels(df, ["k"], "level", ("L1", "L2"), ["v"]).orderBy("k").collect()
    assert [(r.k, r.v_L1, r.v_L2) for r in out] == [(1, 5.0, 6.0), (2, 7.0, None)]


# ---------------------------------------------------------------- A11 / A12 / A13 / A14 / A15 / A16
def _book(tmp_path):
    book = tmp_path / "book"
    for sheet, lines in {"Units Overview": ["Report title", "unit_no,value", "0012,1.5", "0013,2.5"],
                         "Complexes": ["Report title", "subtitle", "complex,n", "K1,3"]}.items():
        d = book / sheet
        d.mkdir(parents=True)
        (d / "part-0.csv").write_text("\n".join(lines) + "\n")
    return str(book)


def test_match_sheet_rules():
    sheets = ["Units Overview", "Complexes", "units"]
    assert FL.match_sheet(sheets, ["units"]) == "units"                 # exact first
    assert FL.match_sheet(sheets, ["COMPLEXES "]) == "Complexes"        # case / trim
    assert FL.match_sheet(sheets, ["overview"]) == "Units Overview"     # substring
    assert FL.match_sheet(sheets, ["missing"]) is None


def test_read_report_with_skipped_rows(spark, tmp_path):
    book = _book(tmp_path)
    schema = T.StructType([T.StructField("unit_no", T.StringType()), T.StructField("value", T.DoubleType())])
    out = FL.read_report(spark, book, {"units": ["unit overview", "units overview"], "complexes": ["complexes"],
                                       "absent": ["nothing"]},
                         schemas={"units": schema}, skip_rows={"units": 1, "complexes": 2})
    assert set(out) == {"units", "complexes"}
    assert sorted((r.unit_no, r.value) for r in out["units"].collect()) == [("0012", 1.5), ("0013", 2.5)]
    assert [(r.complex, r.n) for r in out["complexes"].collect()] == [("K1", "3")]
    fallback = FL.read_report(spark, book, {"x": ["nothing"]}, skip_rows=2, default_first=True)
    assert "x" in fallback
    meta = FL.add_metadata(out["units"], {"company": "c1", "year": 2024})
    assert meta.columns[-2:] == ["company", "year"]


def test_manifest_and_missing_files(spark, tmp_path):
    book = _book(tmp_path)
    man = FL.file_manifest(spark, book, "*.csv")
    assert man.count() == 2
    wanted = spark.createDataFrame([(os.path.join(book, "Complexes", "part-0.csv"),), ("/nope/missing.csv",)], "path string")
    assert [r.path for r in FL.existing_only(spark, wanted, book).collect()] == [os.path.join(book, "Complexes", "part-0.csv")]


# ---------------------------------------------------------------- A3 / D9 with a seed table
def test_seed_exclusions(spark, tmp_path):
    from panelmart.operators.joins import exclude_listed, small_dim

    p = tmp_path / "seed.csv"
    p.write_text("measure,company,year\nmarket_value,A,2000\nmarket_value,B,1999\n")
    seed = FL.read_seed(spark, str(p), "measure string, company string, year int")
    df = spark.createDataFrame([("A",), ("B",), ("C",)], "company string")
    kept = exclude_listed(df, "company", small_dim(seed, 1000), "company",
                          (F.col("measure") == "market_value") & (F.col("year") == 2000))
    assert sorted(r.company for r in kept.collect()) == ["B", "C"]


# ---------------------------------------------------------------- A19 / A21 / A22 / A23
def test_read_sections(spark, tmp_path):
    text = "\n".join(["[other]", "a b c", "[data]", "; comment", "code name lat lon x y", "checksum 123",
                      "1 A 1.0 2.0 3 4", "2 B mid 1.5 2.5 3 4", "3 C mid 1.5 2.5 3 4 more", "bad line", "[tail]", "z"])
    p = tmp_path / "f.ini"
    p.write_text(text)
    wide = {"code": 0, "name": 1, "lat": 3, "lon": 4, "x": 5, "y": 6}   # the extra field stands in the middle
    narrow = {"code": 0, "name": 1, "lat": 2, "lon": 3, "x": 4, "y": 5}
    out = X.read_sections(spark, str(p), "data", [(7, wide), (6, narrow)], header_prefix="code", comment=";", checksum_prefix="checksum")
    got = sorted((r.code, r.lat, r.y) for r in out.collect())
    assert got == [("1", "1.0", "4"), ("2", "1.5", "4"), ("3", "1.5", "4")]   # no header, no checksum, longer lines kept


def test_read_geojson_and_region_fill(spark, tmp_path):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"statcode": "PV20", "name": "North"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
        {"type": "Feature", "properties": {"statcode": "PV21", "name": "South"}, "geometry": None}]}
    p = tmp_path / "p.geojson"
    p.write_text(json.dumps(fc))
    assert X.read_geojson(spark, str(p), ["nowhere"]).filter("nowhere IS NULL").count() == 2
    g = X.read_geojson(spark, str(p), ["statcode", "name"])
    assert [json.loads(r.geometry_json)["coordinates"][0][1] for r in g.filter("statcode = 'PV20'").collect()] == [[1, 0]]
    rows = sorted((r.statcode, r.geometry_type) for r in g.collect())
    assert rows == [("PV20", "Polygon"), ("PV21", None)]
    from panelmart.plans.overrides import region_fill
    values = spark.createDataFrame([("North", 1.0)], "name string, v double")
    filled = region_fill(values, g.select("name"), ["name"]).orderBy("name").collect()
    assert [(r.name, r.no_data) for r in filled] == [("North", False), ("South", True)]


def test_stack_sheets_and_price_index(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "y")], "x int, y string")
    out = X.stack_sheets({"a": a, "b": b})
    assert sorted((r.x, r.y, r._sheet) for r in out.collect()) == [(1, None, "a"), (2, "y", "b")]
    idx = spark.createDataFrame([("2020 December", 100.0), ("2021 June", 104.0), ("2021 December", 110.0)],
                                "period string, idx double")
    got = {r.period: r.yoy for r in X.price_index_yoy(idx, "period", "idx").collect()}
    assert got["2020 December"] is None and round(got["2021 June"], 6) == 0.1


# ---------------------------------------------------------------- A24 / A26 / A27
def test_partition_replace_with_quote(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("o'hara", 1), ("b", 2)], "company string, v int")
    S.replace_partitions(first, path, ["company"])
    S.replace_partitions(spark.createDataFrame([("o'hara", 9)], "company string, v int"), path, ["company"])
    got = sorted((r.company, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("b", 2), ("o'hara", 9)]


def test_write_with_stats_and_export_pair(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, k string")
    stats = S.write_with_stats(df, str(tmp_path / "w"), key="k")
    assert stats["rows"] == 3 and stats["distinct_keys"] == 2 and stats["columns"] == 2
    d, s = S.export_pair(df, df.groupBy("k").count(), str(tmp_path / "e"))
    assert spark.read.parquet(d).count() == 3 and spark.read.parquet(s).count() == 2


# ---------------------------------------------------------------- B9 / B10 / A18
def test_dedupe_and_entity_coverage(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (2, 5)], "k int, v int")
    assert sorted((r.k, r.v) for r in C.dedupe_first(df, ["k"], ["v"]).collect()) == [(1, 2), (2, 5)]
    e = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    f = spark.createDataFrame([("a",), ("c",), ("d",)], "c string")
    a = spark.createDataFrame([("a",)], "c string")
    cats = {r.c: r.category for r in C.entity_coverage(e, f, a, "c").collect()}
    assert cats == {"a": "ok", "b": "missing", "c": "inactive", "d": "ignored"}
    blank = spark.createDataFrame([(" a ",), ("",), ("e",)], "c string")
    cats = {r.c: r.category for r in C.entity_coverage(a, blank, blank, "c").collect()}
    assert cats == {"a": "ok", "e": "unexpected"}
    ds = FL.latest_dataset(spark.createDataFrame([("x", None, 3), ("x", None, 5), ("y", 2, 9)],
                                                 "c string, given long, id long"), ["c"], "given", "id")
    assert sorted((r.c, r.dataset_id) for r in ds.collect()) == [("x", 5), ("y", 2)]


def test_replace_requested_partitions(spark, tmp_path):
    """One company without rows, one with fewer, one with a quote in its name, one left alone."""
    path, schema = str(tmp_path / "t"), "company string, v int"
    old = [("a", 1), ("a", 2), ("b", 3), ("b", 4), ("o'x", 5), ("keep", 6)]
    S.replace_partitions(spark.createDataFrame(old, schema), path, ["company"])
    new = spark.createDataFrame([("b", 7)], schema)
    S.replace_partitions(new, path, ["company"], requested=[("a",), ("b",), ("o'x",)])
    assert rows(spark.read.schema(schema).parquet(path), ["company", "v"]) == [("b", 7), ("keep", 6)]
    S.replace_partitions(new.limit(0), path, ["company"], requested=[("b",)])
    assert rows(spark.read.schema(schema).parquet(path), ["company", "v"]) == [("keep", 6)]
    with pytest.raises(ValueError, match="not requested"):
        S.replace_partitions(new, path, ["company"], requested=[("keep",)])
    assert spark.read.schema(schema).parquet(path).count() == 1


def test_repeated_section(spark, tmp_path):
    """Every section of the name counts; its name is no pattern; an empty one has no lines."""
    (tmp_path / "a.txt").write_text("[Codes]\nID NAME\n1 x\n[Other]\n9 z\n[Codes]\n[Codes]\r\n2 y\r\n# no\nChecksum 3\n")
    (tmp_path / "b.txt").write_text("[C.des]\n3 w\n")
    got = lambda name: rows(X.read_sections(spark, str(tmp_path), name, [(2, {"id": 0, "name": 1})], "ID"), ["id", "name"])
    assert got("Codes") == [("1", "x"), ("2", "y")]
    assert got("C.des") == [("3", "w")]
