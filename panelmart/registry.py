"""Registry of named queries: a Spark plan and its DuckDB oracle SQL.

Each registered query takes a :class:`Catalog` over the driver's tables and
returns a DataFrame; ``oracle`` is the equal SQL text over the same tables
(or ``None`` where SQL cannot express the operator).  ``digits`` names the
double columns that are rounded identically on both sides, so the value hash
does not depend on summation order: exact decimal sums on a decimal grid
finer than their decimals (``fround``), computed means and ratios on a binary
grid (``bround``, no decimal midpoint ties).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .functions.columns import round_for_compare, sql_round_for_compare
from .sources.tables import MATERIALIZE_CONF, Catalog


@dataclass
class Query:
    name: str
    build: Callable[[Catalog], DataFrame]
    sql: str | None
    digits: dict[str, int] = field(default_factory=dict)
    ids: tuple[str, ...] = ()

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(catalog_for(spark, sf_dir))
        if self.digits:
            df = df.select(*[round_for_compare(c, self.digits[c]).alias(c) if c in self.digits else c
                             for c in df.columns])
        return df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.digits:
            return self.sql
        quoted = {c: '"' + c + '"' for c in self.digits}   # names such as "Full" are SQL keywords
        repl = ", ".join(f"{sql_round_for_compare(quoted[c], d)} AS {quoted[c]}" for c, d in self.digits.items())
        return f"SELECT * REPLACE ({repl}) FROM (\n{self.sql}\n) AS q"


REGISTRY: dict[str, Query] = {}
_CATALOGS: dict[tuple[str, str], Catalog] = {}


def catalog_for(spark: SparkSession, sf_dir: str) -> Catalog:
    """A fresh catalog per query; with materialised marts one per application and folder.

    Lazy models are cheap to declare and must see the data as it is now; marts are
    written once on purpose (``spark.panelmart.materialize``).
    """
    if spark.conf.get(MATERIALIZE_CONF, "false").lower() != "true":
        return Catalog(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CATALOGS:
        _CATALOGS[key] = Catalog(spark, sf_dir)
    return _CATALOGS[key]


def register(name: str, sql: str | None, digits: dict[str, int] | None = None, ids: tuple[str, ...] = ()):
    def deco(fn: Callable[[Catalog], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, dict(digits or {}), ids)
        return fn

    return deco
