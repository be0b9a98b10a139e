"""Reshape operators.

Wide → long is a ``inline(array(struct …))`` generator: a narrow,
per-row operation (no shuffle).  Long → wide uses ``pivot`` with an explicit
value list (no extra job to discover values).  Config-driven repetition (G6)
is built as *one* scan with conditional aggregates, not N UNION ALL arms
(R7).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col


def to_long(df: DataFrame, keep: Sequence[str], rows: Sequence[Sequence], names: Sequence[str]) -> DataFrame:
    """G1: ``CROSS JOIN LATERAL (VALUES …)``.

    ``rows`` is a list of tuples; each element is a literal or a Column
    (e.g. ``('market', F.col('market_value'), 1)``); ``names`` are the output
    field names.  Types of a field are unified by the array's common type.
    """
    structs = []
    for r in rows:
        if len(r) != len(names):
            raise ValueError("each row needs one value per name")
        structs.append(F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(n) for v, n in zip(r, names)]))
    return df.select(*keep, F.inline(F.array(*structs)))


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    """Yearly (or any) columns → (name, value) rows."""
    return df.unpivot(list(ids), list(values), name, value)


def pivot_gap(df: DataFrame, by: Sequence[str], kind: str, value: str, a: str, b: str, gap: str = "gap") -> DataFrame:
    """Long → wide by kind (``first`` per cell) and ``a - b``."""
    w = df.groupBy(*by).pivot(kind, [a, b]).agg(F.first(value))
    return w.withColumn(gap, F.col(a) - F.col(b))


def for_each_config(df: DataFrame, by: Sequence[str], configs: Sequence[dict],
                    measures: Callable[[dict], Sequence[tuple[str, Column]]],
                    label: str = "config") -> DataFrame:
    """G6 in the R7 one-scan form.

    Each config has a ``name`` and a ``filter`` Column.  For every config the
    measures are built as conditional aggregates (the config's filter moves
    into ``F.when``) in **one** ``groupBy``; the result is then reshaped to one
    row per (group, config) with G1.  A group with no row for a config is
    dropped through the config's conditional count, exactly like an empty
    UNION arm would give no row.

    ``measures(config)`` returns (name, aggregate-of-conditional) pairs built
    with :func:`when_cfg`.
    """
    aggs: list[Column] = []
    per_cfg: list[list[str]] = []
    for i, cfg in enumerate(configs):
        pairs = list(measures(cfg))
        aggs.append(F.count(F.when(cfg["filter"], F.lit(1))).alias(f"__n{i}"))
        names = []
        for mname, expr in pairs:
            aggs.append(expr.alias(f"__c{i}_{mname}"))
            names.append(mname)
        per_cfg.append(names)
    wide = df.groupBy(*by).agg(*aggs)
    mnames = per_cfg[0]
    rows = []
    for i, cfg in enumerate(configs):
        rows.append((F.lit(cfg["name"]), F.col(f"__n{i}"), *[F.col(f"__c{i}_{m}") for m in mnames]))
    long = to_long(wide, by, rows, [label, "__n", *mnames])
    return long.filter(F.col("__n") > 0).drop("__n")


def when_cfg(cfg: dict, x) -> Column:
    """Value of ``x`` on rows of the config, NULL elsewhere (for conditional aggregates)."""
    return F.when(cfg["filter"], col(x) if isinstance(x, str) else x)
