"""Nested JSON ingest.

Nested payloads are read with Spark's JSON reader (or parsed from a JSON text
column with ``from_json``) and flattened with generators and struct getters:
each record is expanded inside its own task.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import MERGE_COL, indicator_merge


# ---------------------------------------------------------------- A4 / A5
def _opt(df: DataFrame, path: str) -> Column:
    """``F.col(path)`` when the (nested) field exists in the schema, else a NULL (optional payload fields)."""
    dtype: T.DataType = df.schema
    for part in path.split("."):
        if not isinstance(dtype, T.StructType) or part not in dtype.fieldNames():
            return F.lit(None)
        dtype = dtype[part].dataType
    return F.col(path)


# The payload's fields, our column names, their types.
ROUND_FIELDS = [("id", "valuation_round_id", "long"), ("dataSetId", "round_data_set_id", "long"),
                ("issueDate.year", "issue_year", "long"), ("issueDate.quarter", "issue_quarter", "string"),
                ("status", "round_status", "string"), ("isFree", "round_is_free", "boolean")]
VALUATION_FIELDS = [("valuationId", "valuation_id", "long"), ("dataSetId", "valuation_data_set_id", "long"),
                    ("name", "valuation_name", "string"), ("modelYear", "model_year", "long"), ("archived", "archived", "boolean"),
                    ("archivedDateTime", "archived_date_time", "string"), ("creationDateTime", "creation_date_time", "string"),
                    ("dataSetUpdateDateTime", "data_set_update_date_time", "string"), ("avmIssueDate", "avm_issue_date", "string"),
                    ("isOldDataSet", "is_old_data_set", "boolean"), ("hasChangedParameters", "has_changed_parameters", "boolean"),
                    ("isNewCalculationRules", "is_new_calculation_rules", "boolean"), ("mainValuation", "main_valuation", "boolean"),
                    ("subPortfolio.name", "sub_portfolio_name", "string"),
                    ("subPortfolio.valuationLevel", "sub_portfolio_valuation_level", "string")]


def _round_columns(df: DataFrame, prefix: str = "") -> list[Column]:
    o = functools.partial(_opt, df)
    cols = [o(prefix + path).cast(kind).alias(name) for path, name, kind in ROUND_FIELDS]
    year = o(prefix + "issueDate.year").cast("long").cast("string")
    iso = F.when(o(prefix + "issueDate.quarter") == "Q4", F.concat(year, F.lit("-12-31"))).alias("issue_date")
    return [*cols[:4], iso, *cols[4:]]


def _valuation_columns(df: DataFrame, prefix: str = "") -> list[Column]:
    o = functools.partial(_opt, df)
    sub = F.coalesce(o(prefix + "subPortfolio.id").cast("long"), o(prefix + "subPortfolio.subPortfolioId").cast("long"))
    return [*[o(prefix + path).cast(kind).alias(name) for path, name, kind in VALUATION_FIELDS], sub.alias("sub_portfolio_id")]


def flatten_rounds(rounds: DataFrame, valuations: DataFrame, company: str = "company_id") -> DataFrame:
    """A4 from two tables: rounds × their valuations → flat rows; a round without valuations still gives one row.

    ``rounds`` has the company and the round's fields; ``valuations`` has the company,
    ``round_id`` and the valuation's fields.  Round ids are only unique within a
    company, so both are join keys.  A Q4 issue date becomes ISO ``YYYY-12-31``.
    """
    r = rounds.select(F.col(company).alias("company_id"), *_round_columns(rounds))
    v = valuations.select(F.col(company).alias("company_id"), F.col("round_id").cast("long").alias("valuation_round_id"),
                          *_valuation_columns(valuations))
    return r.join(v, ["company_id", "valuation_round_id"], "left")


def flatten_rounds_json(df: DataFrame, company: str = "company_id") -> DataFrame:
    """A4 from one nested payload per company: ``rounds: array<struct>`` with nested ``valuations``.

    Two outer explodes of data that is already nested: no join, no shuffle; a round
    with an empty or missing valuation list keeps one row.
    """
    r = df.select(F.col(company).alias("company_id"), F.explode_outer("rounds").alias("r")).filter(F.col("r").isNotNull())
    nested = "valuations" in r.schema["r"].dataType.fieldNames()
    r = r.select("*", F.explode_outer("r.valuations").alias("v")) if nested else r.withColumn("v", F.lit(None).cast("struct<valuationId: long>"))
    return r.select("company_id", *_round_columns(r, "r."), *_valuation_columns(r, "v."))


def main_valuations(df: DataFrame) -> DataFrame:
    """A5: keep non-archived main valuations; an empty result fails the load."""
    out = df.filter(F.coalesce(F.col("main_valuation"), F.lit(False)) & ~F.coalesce(F.col("archived"), F.lit(False)))
    if out.limit(1).count() == 0:
        raise ValueError("no non-archived main valuation found")
    return out


# ---------------------------------------------------------------- A6 / A7
def flatten(df: DataFrame, sep: str = ".", lists_as_json: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Structs become ``parent<sep>child`` columns (recursively); arrays/maps become JSON text."""
    def walk(prefix: str, col: Column, dtype: T.DataType):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                yield from walk(f"{prefix}{sep}{f.name}" if prefix else f.name, col[f.name], f.dataType)
        elif isinstance(dtype, (T.ArrayType, T.MapType)) and lists_as_json:
            yield F.to_json(col).alias(prefix)
        else:
            yield col.alias(prefix)

    cols = []
    for f in df.schema.fields:
        if f.name in keep:
            cols.append(F.col(f"`{f.name}`"))
        else:
            cols.extend(walk(f.name, F.col(f"`{f.name}`"), f.dataType))
    return df.select(*cols)


def parse_json_column(df: DataFrame, col: str, schema: T.StructType | str, keep: Sequence[str] = ()) -> DataFrame:
    """A6 for a JSON text column: ``from_json`` with a declared schema, then :func:`flatten`."""
    parsed = df.select(*keep, F.from_json(F.col(col), schema).alias(col))
    return flatten(parsed, keep=keep)


def split_branches(df: DataFrame, branches: dict[str, str], keep: Sequence[str]) -> dict[str, DataFrame]:
    """One scan → several tables, one per branch (struct field) of the payload.

    The caller persists ``df`` (or writes each output) so the source is read once.
    """
    return {name: flatten(df.select(*keep, F.col(field).alias(name)).select(*keep, f"{name}.*"), keep=keep)
            for name, field in branches.items()}


# ---------------------------------------------------------------- A8 / A9 / A10
def union_unit_arrays(df: DataFrame, arrays: Sequence[str], id_col: str, number_cols: Sequence[str], keys: Sequence[str],
                      alternatives: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Several arrays of structs as one table; incomplete units dropped, first of each key kept.

    ``number_cols`` and every list in ``alternatives`` (output name → fields) give the
    first non-blank of several fields.  Fields an array lacks are NULL.
    """
    parts = [df.select(F.explode(F.col(a)).alias("u")).select("u.*") for a in arrays]
    rows = functools.reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    for name, fields in {"unit_number": number_cols, **(alternatives or {})}.items():
        given = [F.nullif(F.col(f).cast("string"), F.lit("")) for f in fields if f in rows.columns]
        rows = rows.withColumn(name, F.coalesce(*given) if given else F.lit(None).cast("string"))
    rows = rows.filter(F.col(id_col).isNotNull() & F.col("unit_number").isNotNull())
    return rows.dropDuplicates(list(keys))


def distinct_names(df: DataFrame, array_col: str, field: str | None = None, name: str = "name") -> DataFrame:
    """Distinct trimmed non-empty names from a nested array."""
    e = df.select(F.explode(F.col(array_col)).alias("x"))
    v = F.col(f"x.{field}") if field else F.col("x")
    return e.select(F.trim(v.cast("string")).alias(name)).filter(F.col(name).isNotNull() & (F.col(name) != "")).distinct()


def pivot_levels(records: DataFrame, keys: Sequence[str], level_col: str, levels: tuple[str, str],
                 values: Sequence[str]) -> DataFrame:
    """A10: long → side by side for two levels: filter + rename each level, dedupe, full outer on the keys."""
    sides = []
    for lv in levels:
        s = records.filter(F.col(level_col) == lv).select(*keys, *[F.col(v).alias(f"{v}_{lv}") for v in values])
        sides.append(s.dropDuplicates(list(keys)))
    return indicator_merge(sides[0], sides[1], keys).drop(MERGE_COL)
