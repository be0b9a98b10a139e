"""Report-file ingest, re-aimed at open formats.

The reference reads Excel workbooks one sheet at a time into pandas.  Here a
"workbook" is a folder with one sub-folder per sheet holding CSV / JSON /
Parquet files; the manifest of raw files is a DataFrame; sheet resolution
is done on the *list of folder names* (metadata), and every sheet is read by
Spark's own readers, so each file is parsed in an executor task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ---------------------------------------------------------------- A11 / A12
def match_sheet(available: Sequence[str], candidates: Sequence[str]) -> str | None:
    """First candidate that matches an available sheet name.

    Exact match first, then case-insensitive trimmed equality, then substring
    either way (case-insensitive), candidate by candidate.
    """
    norm = {a: a.strip().lower() for a in available}
    for cand in candidates:
        if cand in available:
            return cand
        c = cand.strip().lower()
        for a, n in norm.items():
            if n == c:
                return a
        for a, n in norm.items():
            if c in n or n in c:
                return a
    return None


def list_sheets(spark: SparkSession, book: str) -> list[str]:
    """Sub-folders of a book, listed through Spark's file system (any store)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(book)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()) if fs.exists(path) else []


def read_sheet(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None,
               skip_rows: int = 0, header: bool = True) -> DataFrame:
    """Read one sheet folder; identifiers stay exact strings when a schema declares them.

    ``skip_rows`` leading report records (A13) are dropped per file before the
    header is parsed, in the executors: a quoted cell may hold line breaks.
    """
    reader = spark.read
    if fmt == "csv" and skip_rows:
        return _csv_skipping(spark, path, skip_rows, schema)
    if fmt == "csv":
        reader = reader.option("header", header)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", False)
        return reader.csv(path)
    if fmt == "json":
        return (reader.schema(schema) if schema is not None else reader).option("multiLine", True).json(path)
    return reader.parquet(path)


# a record: plain stretches and quoted cells (line breaks inside stay; an open quote runs to the end) up to a line end
_RECORD = r'((?:[^"\r\n]++|"[^"]*+(?:"|\z))*+)(?:\r\n|\n|\r|\z)'
_CSV = {"escape": '"'}   # a quote inside a quoted cell is doubled


def _header_names(cells: Column) -> Column:
    """Trimmed header cells; the n-th repeat of a name gets ``.n`` behind it, an empty cell stays NULL."""
    cells = F.transform(cells, lambda x: F.nullif(F.trim(x), F.lit("")))
    earlier = lambda x, i: F.size(F.filter(F.slice(cells, 1, i), lambda y: y == x))
    return F.transform(cells, lambda x, i: F.when(earlier(x, i) > 0, F.concat(x, F.lit("."), earlier(x, i).cast("string"))).otherwise(x))


def _csv_skipping(spark: SparkSession, path, skip_rows: int, schema: T.StructType | None, keep_file: bool = False) -> DataFrame:
    """Drop the first ``skip_rows`` records of every file, then parse the header + rows.

    ``wholetext`` gives one row per file (files of a report are small; each
    file is one task).  Records, not lines, are skipped and parsed: a quoted cell may
    hold line breaks.  Every file has its own header: header and rows are split by
    the same CSV parser and a row's cells are looked up by their header name, so the
    column order may differ from file to file and names may hold any character; repeated
    names are told apart by ``.1``, ``.2`` …
    """
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("source_file"),
                                                       F.regexp_extract_all("value", F.lit(_RECORD), F.lit(1)).alias("l"))
    records = raw.select("source_file", F.filter(F.slice("l", skip_rows + 1, F.greatest(F.size("l") - skip_rows, F.lit(0))),
                                                 lambda x: F.trim(x) != "").alias("l")).filter(F.size("l") > 0)
    widest = records.select(F.max(F.size(F.split(F.element_at("l", 1), ","))).alias("n")).first().n
    if widest is None:
        return spark.createDataFrame([], schema or T.StructType([]))
    cells = ", ".join(f"c{i} string" for i in range(widest))
    split = lambda record: F.from_csv(record, cells, _CSV)
    rows = records.select("source_file", split(F.element_at("l", 1)).alias("h"), "l")
    rows = rows.select("source_file", _header_names(F.array(*[f"h.c{i}" for i in range(widest)])).alias("k"),
                       F.explode(F.slice("l", 2, F.size("l"))).alias("record"))
    rows = rows.select("source_file", "k", split(F.col("record")).alias("r"))
    pairs = F.arrays_zip(F.col("k"), F.array(*[F.col(f"r.c{i}") for i in range(widest)]).alias("v"))
    cell = F.map_from_entries(F.filter(pairs, lambda x: x["k"].isNotNull()))
    rows = rows.select("source_file", cell.alias("row"))
    if schema is None:
        names = [x.k for x in rows.select(F.explode(F.map_keys("row")).alias("k")).distinct().orderBy("k").collect()]
        schema = T.StructType([T.StructField(x, T.StringType()) for x in names])
    file = ["source_file"] if keep_file else []
    return rows.select(*[F.try_element_at("row", F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in schema.fields], *file)


def read_report(spark: SparkSession, book: str, wanted: Mapping[str, Sequence[str]], fmt: str = "csv",
                schemas: Mapping[str, T.StructType] | None = None,
                skip_rows: int | Mapping[str, int] = 0, default_first: bool = False) -> dict[str, DataFrame]:
    """For each wanted output take the first matching sheet; optionally fall back to the first sheet."""
    sheets = list_sheets(spark, book)
    out = {}
    for name, candidates in wanted.items():
        skip = skip_rows.get(name, 0) if isinstance(skip_rows, Mapping) else skip_rows
        matched = match_sheet(sheets, candidates)
        # The first sheet also stands in for a match without rows
        for sheet in dict.fromkeys(x for x in (matched, sheets[0] if default_first and sheets else None) if x is not None):
            frame = read_sheet(spark, f"{book}/{sheet}", fmt, (schemas or {}).get(name), skip)
            if not (default_first and frame.isEmpty()):
                out[name] = frame
                break
    return out


# ---------------------------------------------------------------- A3
def read_seed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A3: a seed CSV (e.g. measure, company, year exclusions) read with a declared schema.

    Seeds are small reference tables; callers join them with ``small_dim``,
    which broadcasts only after the row count is proven bounded.
    """
    return spark.read.option("header", True).schema(schema).csv(path)


# ---------------------------------------------------------------- A14–A18
def add_metadata(df: DataFrame, meta: Mapping[str, object]) -> DataFrame:
    """Constant metadata columns (company, year, as_of …)."""
    return df.withColumns({k: F.lit(v) for k, v in meta.items()})


def read_manifest(spark: SparkSession, manifest: DataFrame, skip_rows: int = 0, schema: T.StructType | None = None,
                  path_col: str = "path") -> DataFrame:
    """All files of a manifest in one job, each row with its file's metadata.

    The folders of the files are listed by the driver (names only); rows are read,
    parsed per file header and joined with the manifest in the executors.
    """
    folders = [r.f for r in manifest.select(F.regexp_replace(path_col, r"/[^/]*$", "").alias("f")).distinct().collect()]
    if not folders:
        return join_manifest(spark.createDataFrame([], T.StructType([*(schema or T.StructType()).fields, T.StructField("source_file", T.StringType())])),
                             manifest, "source_file", path_col).drop("source_file")
    rows = _csv_skipping(spark, folders, skip_rows, schema, keep_file=True)
    return join_manifest(rows, manifest, "source_file", path_col).drop("source_file")


def join_manifest(df: DataFrame, manifest: DataFrame, path_col: str = "source_file", manifest_path: str = "path") -> DataFrame:
    """Metadata of each row's file (company, round, date, data set …) from the manifest.

    Paths are matched without their scheme; rows of files the manifest lacks are dropped.
    """
    m = manifest.withColumn("__path", _plain_path(manifest_path)).drop(manifest_path)
    return df.withColumn("__path", _plain_path(path_col)).join(m, ["__path"]).drop("__path")


def _plain_path(c: str) -> Column:
    return F.regexp_replace(F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B"))), r"^[a-z0-9]+:/+", "/")


def require_root(spark: SparkSession, path: str, kind: str = "object") -> DataFrame:
    """(source_file, value) of whole JSON files; fails where a root is not of ``kind``
    (``object`` or ``array``)."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("source_file"), "value")
    opening = {"object": "{", "array": "["}[kind]
    wrong = raw.filter(~F.ltrim(F.regexp_replace("value", r"^\s+", "")).startswith(opening)).select("source_file").limit(1).collect()
    if wrong:
        raise ValueError(f"{wrong[0].source_file}: expected a JSON {kind}")
    return raw


def file_manifest(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """One row per raw file (path, size, modification time) from the binaryFile source (content not read)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    return df.select("path", "length", "modificationTime")


def existing_only(spark: SparkSession, manifest: DataFrame, root: str, path_col: str = "path") -> DataFrame:
    """Skip manifest rows whose file is missing.

    The files that exist are listed by the binaryFile source (metadata only)
    and matched with a left-semi join on the normalised path, so the
    manifest never passes through the driver.
    """
    present = file_manifest(spark, root).select(_plain_path("path").alias("__p"))
    return manifest.join(present, _plain_path(path_col) == F.col("__p"), "left_semi")


def round_metadata(df: DataFrame, company: str | None = None) -> DataFrame:
    """Distinct (company, round, date, dataset); the date defaults to the year's 31 December."""
    need = {"company_id", "valuation_round_id", "issue_year"}
    if not need.issubset(df.columns):
        return df.sparkSession.createDataFrame(
            [], "company_id string, valuation_round_id long, issue_date string, round_data_set_id long")
    out = df if company is None else df.filter(F.col("company_id") == company)

    def given(name: str, kind: str) -> Column:
        """The column, blank and NaN cells as NULL; NULL where there is no such column."""
        if name not in df.columns:
            return F.lit(None).cast(kind)
        text = F.trim(F.col(name).cast("string"))
        return F.when(~F.lower(text).isin("", "nan"), text).try_cast("double" if kind == "long" else kind).try_cast(kind)

    year_end = F.concat(F.col("issue_year").cast("long").cast("string"), F.lit("-12-31"))
    date = F.coalesce(given("issue_date", "string"), year_end)
    data_set = given("data_set_id" if "data_set_id" in df.columns else "round_data_set_id", "long")
    return out.select("company_id", "valuation_round_id", date.alias("issue_date"), data_set.alias("round_data_set_id")).dropDuplicates()


def latest_dataset(df: DataFrame, by: Sequence[str], given: str, ids: str, name: str = "dataset_id") -> DataFrame:
    """Per group, the given dataset id or else the maximum id of the group."""
    return df.groupBy(*by).agg(F.coalesce(F.max(given), F.max(ids)).alias(name))
