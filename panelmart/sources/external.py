"""External reference tables.

Text and JSON inputs are read with Spark's own readers (``text`` with
``wholetext`` for section files, ``json`` with ``multiLine`` for GeoJSON),
then parsed with built-in string/JSON functions: the parsing runs in the
executors, one file or line per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import year_of
from ..operators.windows import pct_change


def price_index_yoy(df: DataFrame, period: str, index: str, month_word: str = "december") -> DataFrame:
    """Keep the rows of one month, take the year from the text, YoY change, map back to every period.

    The YoY window runs over one row per year (bounded), then a join brings
    the change back to all periods of that year.
    """
    dec = df.filter(F.lower(F.col(period)).contains(month_word)).select(year_of(period).alias("year"), index)
    yoy = dec.select("year", pct_change(index, "year").alias("yoy"))
    return df.select(period, year_of(period).alias("year"), index).join(yoy, ["year"], "left")


def region_table(df: DataFrame, renames: Mapping[str, str], keep: Sequence[str] | None = None) -> DataFrame:
    """Rename coded columns, trim every string column, project."""
    out = df.withColumnsRenamed(dict(renames))
    out = out.select(*[F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                       for f in out.schema.fields])
    return out.select(*keep) if keep else out


def stack_sheets(frames: Mapping[str, DataFrame], label: str = "_sheet") -> DataFrame:
    """Union all sheets by name (missing columns NULL) with a sheet-label column."""
    out = None
    for name, df in frames.items():
        d = df.withColumn(label, F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def read_sections(spark: SparkSession, path: str, section: str, layouts: Sequence[tuple[int, Mapping[str, int]]],
                  header_prefix: str, comment: str = "#", checksum_prefix: str = "Checksum") -> DataFrame:
    """One ``[section]`` of INI-style text files → a table.

    Blank, comment, header (``header_prefix``) and checksum lines are dropped.  A line
    splits on white space; the first layout ``(n, {column: position})`` whose ``n`` it
    reaches gives its columns (longer lines are no error), lines too short for any
    layout are dropped.  A line belongs to the section if the last ``[...]`` line before
    it in its file names it; a section that a file repeats counts each time.  A file is
    one row while it is cut into lines.
    """
    raw = spark.read.text(path, wholetext=True).select(F.col("value"), F.input_file_name().alias("source_file"))
    quoted = "\\Q" + section.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    pattern = rf"(?s)(?:^|\n)[ \t]*\[{quoted}\][ \t]*\r?(?=\n|\z)(.*?)(?=\n[ \t]*\[|\z)"
    bodies = raw.select("source_file", F.explode(F.regexp_extract_all("value", F.lit(pattern), 1)).alias("body"))
    lines = bodies.select("source_file", F.explode(F.split("body", r"\r?\n")).alias("line"))
    line = F.col("line")
    lines = lines.select("source_file", F.trim(F.regexp_replace(line, r"\s+", " ")).alias("line")).filter(
        (line != "") & ~line.startswith(comment) & ~line.startswith(header_prefix) & ~line.startswith(checksum_prefix))
    parts = lines.select("source_file", F.split("line", " ").alias("p"))
    fits = [(F.size("p") >= n, fields) for n, fields in layouts]
    names = list(dict.fromkeys(name for _, fields in layouts for name in fields))
    cols = []
    for name in names:
        value = F.lit(None).cast("string")
        for cond, fields in reversed(fits):
            value = F.when(cond, F.get("p", F.lit(fields[name])) if name in fields else F.lit(None)).otherwise(value)
        cols.append(value.alias(name))
    return parts.filter(F.size("p") >= min(n for n, _ in layouts)).select(*cols, "source_file")


def read_geojson(spark: SparkSession, path: str, props: Sequence[str]) -> DataFrame:
    """FeatureCollection files → one row per feature, geometry kept as JSON text.

    A property that no feature has, or that this one lacks, is NULL.
    """
    schema = "features array<struct<properties: map<string, string>, geometry: struct<type: string, coordinates: string>>>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path).select(
        F.explode("features").alias("f"), F.input_file_name().alias("source_file"))
    geometry = F.concat(F.lit('{"type":'), F.to_json(F.array("f.geometry.type")).substr(F.lit(2), F.length(F.to_json(F.array("f.geometry.type"))) - 2),
                        F.lit(',"coordinates":'), F.coalesce("f.geometry.coordinates", F.lit("null")), F.lit("}"))
    return raw.select(
        "source_file",
        *[F.try_element_at("f.properties", F.lit(p)).alias(p) for p in props],
        F.col("f.geometry.type").alias("geometry_type"),
        F.when(F.col("f.geometry").isNotNull(), geometry).alias("geometry_json"),
    )
