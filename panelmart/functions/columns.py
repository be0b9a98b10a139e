"""Column-returning helpers.

Every helper returns a ``pyspark.sql.Column`` built from built-in functions,
so it stays inside whole-stage codegen; none of them is a Python UDF.
Arguments are column names or Columns; domain values are always parameters.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


# ---------------------------------------------------------------- rounding
# From 2^52 on a double has no fraction left, so there is nothing to round; it is
# also far below 2^63, where Spark's floor (a 64-bit integer) would saturate.
_WHOLE = float(2**52)


def _on_grid(c: ColumnOrName, scale: float) -> Column:
    x = col(c).cast("double")
    scaled = x * F.lit(scale)
    return F.when(F.abs(scaled) < F.lit(_WHOLE), F.floor(scaled + F.lit(0.5)) / F.lit(scale)).otherwise(x).cast("double")


def _sql_on_grid(expr: str, scale: float) -> str:
    x = f"CAST(({expr}) AS DOUBLE)"
    return f"CASE WHEN abs({x} * {scale!r}) < {_WHOLE!r} THEN floor({x} * {scale!r} + 0.5) / {scale!r} ELSE {x} END"


def fround(c: ColumnOrName, digits: int) -> Column:
    """Round half up as ``floor(x * 10^d + 0.5) / 10^d``.

    Chosen over ``round`` because it is bit-identical in Spark and in the SQL
    oracle (both do the same IEEE multiply, add and floor), while ``round`` on
    doubles differs between engines at decimal ties (SURVEY §7.3 S5).
    """
    return _on_grid(c, float(10**digits))


def sql_fround(expr: str, digits: int) -> str:
    """SQL text of :func:`fround` for the oracle side."""
    return _sql_on_grid(expr, float(10**digits))


class Bits(int):
    """A rounding grid of ``2**-bits`` (see :func:`bround`)."""


def bround(c: ColumnOrName, bits: int) -> Column:
    """Round to the nearest multiple of ``2**-bits`` (half up).

    For computed (non-decimal) values such as means and ratios: scaling by a
    power of two is exact, so the result is bit-identical in every engine for
    identical inputs, and — unlike decimal rounding — a decimal midpoint such
    as x.xxxxx5 is never a tie, so two engines whose sums differ only in the
    last bit do not round a mean of many prices to different decimals.
    """
    return _on_grid(c, float(2**bits))


def sql_bround(expr: str, bits: int) -> str:
    return _sql_on_grid(expr, float(2**bits))


def round_for_compare(c: ColumnOrName, digits: int) -> Column:
    """:func:`bround` for :class:`Bits`, else :func:`fround`."""
    return bround(c, int(digits)) if isinstance(digits, Bits) else fround(c, digits)


def sql_round_for_compare(expr: str, digits: int) -> str:
    return sql_bround(expr, int(digits)) if isinstance(digits, Bits) else sql_fround(expr, digits)


# ---------------------------------------------------------------- C3 / C4
def relabel(c: ColumnOrName, mapping: Mapping[str, str], default: ColumnOrName | None = None) -> Column:
    """CASE-style label normalisation; unmapped values keep ``default`` (the input)."""
    c = col(c)
    out = None
    for src, dst in mapping.items():
        out = F.when(c == F.lit(src), F.lit(dst)) if out is None else out.when(c == F.lit(src), F.lit(dst))
    fallback = c if default is None else col(default)
    return fallback if out is None else out.otherwise(fallback)


def area_label(city: ColumnOrName, province: ColumnOrName, keep: Iterable[str], rename: Mapping[str, str] | None = None) -> Column:
    """C4: listed cities keep their own (optionally renamed) name, others take the province."""
    city = col(city)
    label = F.when(city.isin(list(keep)), city).otherwise(col(province))
    return relabel(label, rename or {})


# ---------------------------------------------------------------- C5 / C6 / C9
def any_flag(cols: Sequence[ColumnOrName], hits: Sequence) -> Column:
    """True when any of the columns holds one of ``hits`` (NULL cells count as no hit)."""
    parts = [F.coalesce(col(c).isin(list(hits)), F.lit(False)) for c in cols]
    return functools.reduce(operator.or_, parts)


def count_flags(cols: Sequence[ColumnOrName], hits: Sequence) -> Column:
    """Number of columns whose value is in ``hits``."""
    parts = [F.when(col(c).isin(list(hits)), F.lit(1)).otherwise(F.lit(0)) for c in cols]
    return functools.reduce(operator.add, parts)


def count_positive(cols: Sequence[ColumnOrName]) -> Column:
    """Number of columns with a value > 0 (NULL is not positive)."""
    parts = [F.when(col(c) > 0, F.lit(1)).otherwise(F.lit(0)) for c in cols]
    return functools.reduce(operator.add, parts)


# ---------------------------------------------------------------- C7 / C8
def mean_cols(cols: Sequence[ColumnOrName], default: ColumnOrName | float | None = 0.0, n: int | None = None) -> Column:
    """Mean over N columns.

    ``default`` replaces NULL cells (a number, or a fall-back column as in C7);
    with ``default=None`` any NULL cell makes the result NULL (C8's
    null-propagating variation).  ``n`` is the divisor (defaults to len(cols)).
    """
    n = n or len(cols)
    if default is None:
        cells = [col(c) for c in cols]
    else:
        d = col(default) if isinstance(default, (str, Column)) else F.lit(float(default))
        cells = [F.coalesce(col(c), d) for c in cols]
    return functools.reduce(operator.add, cells) / F.lit(float(n))


# ---------------------------------------------------------------- C10 / C11
def rate_by(key: ColumnOrName, year: ColumnOrName, table: Mapping[tuple, float], default=None) -> Column:
    """Constant looked up by (key, year) from a parameter map."""
    key, year = col(key), col(year)
    out = None
    for (k, y), v in table.items():
        cond = (key == F.lit(k)) & (year == F.lit(y))
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def corrected(base: ColumnOrName, flag: ColumnOrName, flag_value: str, scenario: ColumnOrName,
              terms: Mapping[str, tuple[ColumnOrName, ColumnOrName]]) -> Column:
    """C11: base - removed + coalesce(added, 0) when the flag is set, chosen by scenario."""
    out = None
    for scen, (removed, added) in terms.items():
        cond = (col(flag) == F.lit(flag_value)) & (col(scenario) == F.lit(scen))
        val = col(base) - col(removed) + F.coalesce(col(added), F.lit(0.0))
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(col(base))


# ---------------------------------------------------------------- C12–C14
def abs_change(cur: ColumnOrName, prev: ColumnOrName) -> Column:
    """Absolute change."""
    return col(cur) - col(prev)


def rel_change(cur: ColumnOrName, prev: ColumnOrName, require_current_nonzero: bool = False) -> Column:
    """Relative change; NULL when the prior value is 0 (nullif guard).

    ``require_current_nonzero`` gives the variation that is NULL when current = 0.
    """
    rel = (col(cur) - col(prev)) / F.nullif(col(prev), F.lit(0))
    if require_current_nonzero:
        return F.when(col(cur) != 0, rel)
    return rel


def as_index(rel: ColumnOrName) -> Column:
    """Index form x*100+100."""
    return col(rel) * F.lit(100) + F.lit(100)


def pct_text(x: ColumnOrName, decimals: int = 1) -> Column:
    """C14/H9: percent text with a decimal comma, e.g. 0.1234 -> '12,3%'.

    NULL stays NULL (S4).  The value is rounded half up with :func:`fround`
    before formatting, so the text is the same in every engine (S3).
    """
    v = fround(col(x) * F.lit(100), decimals)
    return F.when(col(x).isNotNull(), F.replace(F.format_string(f"%.{decimals}f%%", v), F.lit("."), F.lit(",")))


def sql_pct_text(expr: str, decimals: int = 1) -> str:
    v = sql_fround(f"({expr}) * 100", decimals)
    return f"CASE WHEN ({expr}) IS NOT NULL THEN replace(printf('%.{decimals}f%%', {v}), '.', ',') END"


# ---------------------------------------------------------------- C15 / C16
def bucket(x: ColumnOrName, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Half-open buckets ``x < edge_i -> label_i``; the last label takes >= and NULL."""
    if len(labels) != len(edges) + 1:
        raise ValueError("bucket needs len(labels) == len(edges) + 1")
    x = col(x)
    out = F.when(x < F.lit(edges[0]), F.lit(labels[0]))
    for e, lab in zip(edges[1:], labels[1:-1]):
        out = out.when(x < F.lit(e), F.lit(lab))
    return out.otherwise(F.lit(labels[-1]))


def bucket_order(label: ColumnOrName, labels: Sequence[str]) -> Column:
    """Sort key 1..n of a bucket label."""
    return order_by_map(label, labels)


def bin_between(x: ColumnOrName, ranges: Sequence[tuple[float, float, str]]) -> tuple[Column, Column]:
    """Inclusive BETWEEN bins -> (label, order); no match gives NULLs."""
    x = col(x)
    lab = order = None
    for i, (lo, hi, name) in enumerate(ranges, start=1):
        cond = x.between(lo, hi)
        lab = F.when(cond, F.lit(name)) if lab is None else lab.when(cond, F.lit(name))
        order = F.when(cond, F.lit(i)) if order is None else order.when(cond, F.lit(i))
    return lab, order


# ---------------------------------------------------------------- C24 / H1
def equal_at(a: ColumnOrName, b: ColumnOrName, scale: int = 2) -> Column:
    """1 when a and b are equal after rounding to ``scale`` decimals, else 0."""
    return F.when(fround(a, scale) == fround(b, scale), F.lit(1)).otherwise(F.lit(0))


def order_by_map(c: ColumnOrName, order: Sequence[str]) -> Column:
    """H1: business order as 1..n; unknown values give NULL (sort them last explicitly)."""
    c = col(c)
    out = None
    for i, v in enumerate(order, start=1):
        out = F.when(c == F.lit(v), F.lit(i)) if out is None else out.when(c == F.lit(v), F.lit(i))
    return out


# ---------------------------------------------------------------- H8–H15
def geo_key(code: ColumnOrName, prefix: str = "GM", width: int = 4) -> Column:
    """Computed dimension key ``prefix || lpad(code, width, '0')``."""
    return F.concat(F.lit(prefix), F.lpad(col(code).cast("string"), width, "0"))


def prefix_key(text: ColumnOrName, n: int = 4) -> Column:
    """First n characters (1-based inclusive slice [1:n])."""
    return F.substring(col(text), 1, n)


def norm_text(c: ColumnOrName) -> Column:
    """H8: lower(trim(x)) for case-insensitive comparisons."""
    return F.lower(F.trim(col(c)))


def to_double(c: ColumnOrName) -> Column:
    """TRY_CAST to double (bad text -> NULL)."""
    return col(c).try_cast("double")


def is_valid_number(c: ColumnOrName) -> Column:
    """Not NULL and not NaN."""
    return col(c).isNotNull() & ~F.isnan(col(c))


def year_of(text: ColumnOrName, pattern: str = r"(\d{4})") -> Column:
    """First 4-digit year in a text, as int (NULL when absent)."""
    return F.nullif(F.regexp_extract(col(text), pattern, 1), F.lit("")).cast("int")


def safe_name(text: ColumnOrName) -> Column:
    """File-name-safe text (anything but word characters, '-' and '.' becomes '_')."""
    return F.regexp_replace(col(text), r"[^\w\-.]", "_")


def json_text(c: ColumnOrName) -> Column:
    """Nested value as JSON text."""
    return F.to_json(col(c))


def as_of(year: ColumnOrName, month: int = 12, day: int = 31) -> Column:
    """Constant valuation date of a year."""
    return F.make_date(col(year), F.lit(month), F.lit(day))
