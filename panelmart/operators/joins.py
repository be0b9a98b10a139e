"""Join operators.

Conventions: keys are passed as a list of column names; outer joins use
explicit conditions and ``F.coalesce`` for key unification (C2) so both sides'
columns stay addressable.  Broadcasting is only done for a side whose row
count was checked (``small_dim``); beyond the bound the plain join is kept and
AQE may still turn it into a broadcast at runtime from measured sizes.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MERGE_COL = "_merge"
MAX_BROADCAST_BYTES = 64 << 20   # widest table (rows x estimated row size) that gets a broadcast hint


# ---------------------------------------------------------------- broadcast guard
def fits(df: DataFrame, max_rows: int, incremental: bool = False) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    With ``incremental`` the check is a ``take`` of ``max_rows + 1`` one-column
    rows: Spark scans partitions incrementally (one, then more) and stops once it
    has enough, so a huge scan answers after a few partitions.  Otherwise it is a
    count: every partition counts its own rows and one number per partition meets
    in the last task.  Nothing is remembered: the data may change between calls.
    """
    if incremental:
        return len(df.select(F.lit(1).alias("x")).limit(max_rows + 1).collect()) <= max_rows
    return df.agg(F.count(F.lit(1)).alias("n")).first().n <= max_rows


def small_dim(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast-hint a dimension only after proving its rows and bytes are bounded.

    Bytes: the measured row count times the row size of the schema (strings at 64
    bytes), a bound that does not depend on how well the files are compressed.
    """
    width = sum(_WIDTHS.get(f.dataType.typeName(), 64) for f in df.schema.fields) or 1
    return F.broadcast(df) if fits(df, min(max_rows, MAX_BROADCAST_BYTES // width)) else df


_WIDTHS = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "long": 8, "float": 4, "double": 8, "date": 4, "timestamp": 8}


# ---------------------------------------------------------------- C1 / C2
def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """SELECT * EXCLUDE (...)."""
    return df.drop(*cols)


def unify_keys(left: DataFrame, right: DataFrame, on: Sequence[str], *more: DataFrame) -> list[Column]:
    """COALESCE of the same key over 2 or 3 sides."""
    sides = (left, right, *more)
    return [F.coalesce(*[s[k] for s in sides]).alias(k) for k in on]


def _prefixed(df: DataFrame, on: Sequence[str], tag: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{tag}{c}") if c in on else F.col(c) for c in df.columns])


def _key_cond(on: Sequence[str], ltag: str, rtag: str) -> Column:
    return functools.reduce(lambda a, b: a & b, [F.col(f"{ltag}{k}") == F.col(f"{rtag}{k}") for k in on])


# ---------------------------------------------------------------- D1 / I2
def indicator_merge(left: DataFrame, right: DataFrame, on: Sequence[str], drop_right: Sequence[str] = (),
                    keys: str = "coalesce", indicator: str = MERGE_COL) -> DataFrame:
    """Full outer equi join with a ``_merge`` column (both / left_only / right_only).

    ``keys='coalesce'`` returns one unified key column per key (C2);
    ``keys='left'`` keeps the left side's keys only (NULL on right-only rows,
    as the reference's ``l.*`` does, Q3/Q4).  Columns named in ``drop_right``
    are removed from the right side first (C1); any other right column that
    clashes with a left one raises (nothing is dropped that was not named).
    """
    on = list(on)
    rcols = [c for c in right.columns if c not in on and c not in drop_right]
    clash = sorted(set(rcols) & set(left.columns))
    if clash:
        raise ValueError(f"columns on both sides: {clash}; rename them or name them in drop_right")
    l = _prefixed(left, on, "__l_").withColumn("__lhit", F.lit(True))
    r = _prefixed(right.select(*on, *rcols), on, "__r_").withColumn("__rhit", F.lit(True))
    j = l.join(r, _key_cond(on, "__l_", "__r_"), "full_outer")
    if keys == "coalesce":
        key_cols = [F.coalesce(F.col(f"__l_{k}"), F.col(f"__r_{k}")).alias(k) for k in on]
    else:
        key_cols = [F.col(f"__l_{k}").alias(k) for k in on]
    merge = (
        F.when(F.col("__lhit") & F.col("__rhit"), F.lit("both"))
        .when(F.col("__lhit").isNotNull(), F.lit("left_only"))
        .otherwise(F.lit("right_only"))
    )
    lcols = [c for c in left.columns if c not in on]
    return j.select(*key_cols, *lcols, *rcols, merge.alias(indicator))


# ---------------------------------------------------------------- D2
def full_outer3(a: DataFrame, b: DataFrame, c: DataFrame, on: Sequence[str]) -> DataFrame:
    """A ⟗ b on keys, then ⟗ c on COALESCE(a.k, b.k) = c.k; keys unified."""
    on = list(on)
    a_, b_, c_ = _prefixed(a, on, "__a_"), _prefixed(b, on, "__b_"), _prefixed(c, on, "__c_")
    ab = a_.join(b_, _key_cond(on, "__a_", "__b_"), "full_outer")
    cond = functools.reduce(
        lambda x, y: x & y,
        [F.coalesce(F.col(f"__a_{k}"), F.col(f"__b_{k}")) == F.col(f"__c_{k}") for k in on],
    )
    abc = ab.join(c_, cond, "full_outer")
    keys = [F.coalesce(F.col(f"__a_{k}"), F.col(f"__b_{k}"), F.col(f"__c_{k}")).alias(k) for k in on]
    rest = [c for c in abc.columns if not c.startswith(("__a_", "__b_", "__c_"))]
    return abc.select(*keys, *rest)


# ---------------------------------------------------------------- D3 / I3 / R8
def star_full_outer(base: DataFrame, others: Sequence[DataFrame], on: Sequence[str], keys: str = "coalesce",
                    method: str = "union") -> DataFrame:
    """N inputs all full-outer-joined to the *base* key.

    Semantics are the chain ``base ⟗ o1 ON base.k = o1.k ⟗ o2 ON base.k = o2.k …``:
    a row of ``o_i`` that matches no base row becomes its own row with NULL
    base columns (it is never merged with a row of another input).

    ``method='chain'`` writes that chain literally: every full outer join
    re-shuffles its whole left side.  ``method='union'`` (R8) is the equal
    form ``(base ⟕ o1 ⟕ … ⟕ oN) ∪ (o1 ▷ base) ∪ … ∪ (oN ▷ base)``: the left
    joins keep the base's key partitioning, so each input is shuffled once.
    ``keys='coalesce'`` fills the key of input-only rows from that input;
    ``keys='base'`` leaves it NULL as the reference does (Q4).
    """
    on = list(on)
    others = list(others)
    payload = [[c for c in o.columns if c not in on] for o in others]
    if method == "chain":
        cur = _prefixed(base, on, "__b_")
        for i, o in enumerate(others):
            oo = _prefixed(o, on, f"__o{i}_")
            cur = cur.join(oo, _key_cond(on, "__b_", f"__o{i}_"), "full_outer")
        if keys == "coalesce":
            kcols = [F.coalesce(F.col(f"__b_{k}"), *[F.col(f"__o{i}_{k}") for i in range(len(others))]).alias(k) for k in on]
        else:
            kcols = [F.col(f"__b_{k}").alias(k) for k in on]
        rest = [c for c in cur.columns if not c.startswith("__")]
        return cur.select(*kcols, *rest)

    cur = base
    for o in others:
        cur = cur.join(o, on, "left")
    out = cur
    all_cols = out.columns
    for i, o in enumerate(others):
        only = o.join(base.select(*on), on, "left_anti")
        keep = set(payload[i]) | (set(on) if keys == "coalesce" else set())
        padded = only.select(
            *[
                (F.col(c) if c in keep else F.lit(None).cast(out.schema[c].dataType)).alias(c)
                for c in all_cols
            ]
        )
        out = out.unionByName(padded)
    return out


# ---------------------------------------------------------------- D5 / D6 / D7
def join_filtered(left: DataFrame, right: DataFrame, on: Sequence[str], pred: Column | None = None) -> DataFrame:
    """Inner join with a predicate on the dimension (moved below the join)."""
    if pred is not None:
        right = right.filter(pred)
    return left.join(right, list(on), "inner")


def enrich(fact: DataFrame, dim: DataFrame, on: Sequence[str] | Column, max_dim_rows: int | None = None) -> DataFrame:
    """Left enrichment; the dimension is broadcast only when its size is proven."""
    if max_dim_rows:
        dim = small_dim(dim, max_dim_rows)
    return fact.join(dim, on if isinstance(on, Column) else list(on), "left")


def geo_chain(df: DataFrame, steps: Sequence[tuple[Column, DataFrame, str]], max_dim_rows: int = 1_000_000) -> DataFrame:
    """A chain of left joins on *computed* keys.

    ``steps`` holds (key expression on the current frame, dimension, dimension
    key column).  Each dimension is size-checked before it is broadcast.
    """
    out = df
    for i, (key, dim, dim_key) in enumerate(steps):
        tmp = f"__geo_key_{i}"
        out = out.withColumn(tmp, key)
        d = small_dim(dim, max_dim_rows)
        out = out.join(d, out[tmp] == d[dim_key], "left").drop(tmp)
    return out


# ---------------------------------------------------------------- D8 / D9 / D10
def exclude_groups(df: DataFrame, keys: Sequence[str], pred: Column) -> DataFrame:
    """Drop a whole group (e.g. complex) when any of its rows matches ``pred``.

    The offending keys are found with a distinct (partial aggregate) and
    removed with a left-anti join on the group keys.
    """
    bad = df.filter(pred).select(*keys).distinct()
    return df.join(bad, list(keys), "left_anti")


def exclude_listed(df: DataFrame, key: str, listed: DataFrame, listed_key: str, filt: Column | None = None) -> DataFrame:
    """``key NOT IN (SELECT listed_key FROM listed WHERE filt)`` with SQL's NULL rules.

    NOT IN is null-aware: if the list holds a NULL, no row passes; a NULL
    key passes only when the list is empty.  Built from a left-anti join plus
    one aggregate row over the list (has_rows, has_null), so it stays a join
    and never collects the list to the driver.
    """
    lst = listed if filt is None else listed.filter(filt)
    lst = lst.select(F.col(listed_key).alias("__nk"))
    has_rows = lst.agg((F.count(F.lit(1)) > 0).alias("r")).scalar()
    has_null = lst.agg((F.count(F.lit(1)) > F.count("__nk")).alias("n")).scalar()
    kept = df.join(lst.filter(F.col("__nk").isNotNull()).distinct(), F.col(key) == F.col("__nk"), "left_anti")
    return kept.filter(~has_rows | (~has_null & F.col(key).isNotNull()))


def keep_groups(df: DataFrame, keys: Sequence[str], having: Column, agg: Sequence[Column]) -> DataFrame:
    """Keep rows whose group satisfies a HAVING predicate (left-semi join)."""
    good = df.groupBy(*keys).agg(*agg).filter(having).select(*keys)
    return df.join(good, list(keys), "left_semi")


# ---------------------------------------------------------------- D11 / D12 / D13
def compare_aggregates(cur: DataFrame, prev: DataFrame, by: Sequence[str], value: str,
                       cur_name: str = "current", prev_name: str = "prior", diff_name: str = "difference") -> DataFrame:
    """Full outer join of two aggregates with unified labels and difference."""
    c = cur.select(*by, F.col(value).alias(cur_name))
    p = prev.select(*by, F.col(value).alias(prev_name))
    j = indicator_merge(c, p, by).drop(MERGE_COL)
    return j.withColumn(diff_name, F.coalesce(F.col(cur_name), F.lit(0)) - F.coalesce(F.col(prev_name), F.lit(0)))


def compare_years(agg: DataFrame, by: Sequence[str], time: str, cur, prev, values: Sequence[str],
                  suffix: str | None = None) -> DataFrame:
    """Current vs prior slice of a per-year aggregate, as an inner join."""
    suffix = suffix or f"_{prev}"
    c = agg.filter(F.col(time) == cur).drop(time)
    p = agg.filter(F.col(time) == prev).select(*by, *[F.col(v).alias(v + suffix) for v in values])
    return c.join(p, list(by), "inner")


def unit_match(cur: DataFrame, prev: DataFrame, params: DataFrame, on: Sequence[str]) -> DataFrame:
    """Three-way inner join prior / current / parameters on unit keys."""
    return cur.join(prev, list(on), "inner").join(params, list(on), "inner")


# ---------------------------------------------------------------- D14 / D15 / D16 / D17 / D18
def cross_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row.

    Each column becomes an uncorrelated scalar subquery (evaluated once,
    then a literal in the projection), so no Cartesian join is planned.
    """
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])


def complete(df: DataFrame, key: str, domain: DataFrame, fill: dict) -> DataFrame:
    """Left join from a full domain (e.g. all buckets) and fill missing measures."""
    out = domain.join(df, [key], "left")
    return out.fillna(fill)


def fill_regions(values: DataFrame, regions: DataFrame, on: Sequence[str], flag: str = "no_data") -> DataFrame:
    """Every region, with a flag for regions without data."""
    v = values.withColumn("__has", F.lit(True))
    out = regions.join(v, list(on), "left")
    return out.withColumn(flag, F.col("__has").isNull()).drop("__has")


def orphans(child: DataFrame, parent: DataFrame, on: Sequence[str] | Column) -> DataFrame:
    """Child rows without a parent (left join + IS NULL == left-anti)."""
    return child.join(parent, on if isinstance(on, Column) else list(on), "left_anti")
