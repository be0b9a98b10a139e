"""Hand-made frames for the NULL / NaN / tie / edge cases (FIXTURES §4) and rewrite properties."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from support import rows
from panelmart.functions import columns as C
from panelmart.functions import predicates as P
from panelmart.operators import aggregates as A
from panelmart.operators import joins as J
from panelmart.operators import reshape as R
from panelmart.operators import windows as W


# ---------------------------------------------------------------- nulls_and_nan
def test_rel_change_guards_zero_and_null(spark):
    df = spark.createDataFrame([(10.0, 0.0), (None, 5.0), (0.0, 5.0), (6.0, 4.0)], "cur double, prev double")
    out = df.select(C.rel_change("cur", "prev").alias("r"),
                    C.rel_change("cur", "prev", require_current_nonzero=True).alias("r0")).collect()
    assert [r.r for r in out] == [None, None, -1.0, 0.5]
    assert [r.r0 for r in out] == [None, None, None, 0.5]


def test_pct_text_null_and_ties(spark):
    df = spark.createDataFrame([(None,), (0.1225,), (0.12345,), (-0.05,)], "x double")
    got = [r.t for r in df.select(C.pct_text("x").alias("t")).collect()]
    assert got[0] is None
    assert got[1] == "12,3%"  # tie rounded half up, the same rule as the SQL oracle
    assert got[2] == "12,3%"
    assert got[3] == "-5,0%"


def test_fround_matches_duckdb_bit_for_bit(spark):
    vals = [1.005, 2.675, 0.1 + 0.2, 12.25, -3.14159, 1e6 / 7, 123456.785]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.y for r in df.select(C.fround("x", 2).alias("y")).collect()]
    con = duckdb.connect()
    want = [con.execute(f"SELECT {C.sql_fround(f'CAST({v!r} AS DOUBLE)', 2)}").fetchone()[0] for v in vals]
    assert got == want


def test_bucket_edges_and_null(spark):
    edges, labels = [0.0, 0.5], ["low", "mid", "high"]
    df = spark.createDataFrame([(-0.1,), (0.0,), (0.5,), (None,), (float("nan"),)], "x double")
    got = [r.b for r in df.select(C.bucket("x", edges, labels).alias("b")).collect()]
    # half-open buckets; NULL falls to the last label; NaN is larger than every number
    assert got == ["low", "mid", "high", "high", "high"]


def test_mean_cols_two_conventions(spark):
    df = spark.createDataFrame([(1.0, None, 3.0)], "a double, b double, c double")
    r = df.select(C.mean_cols(["a", "b", "c"], 0.0).alias("z"), C.mean_cols(["a", "b", "c"], None).alias("s"),
                  C.mean_cols(["a", "b", "c"], "c").alias("f")).first()
    assert r.z == pytest.approx(4.0 / 3)
    assert r.s is None
    assert r.f == pytest.approx(7.0 / 3)


def test_count_flags_and_any_flag(spark):
    df = spark.createDataFrame([("own", None, "own"), (None, None, None)], "a string, b string, c string")
    r = df.select(C.count_flags(["a", "b", "c"], ["own"]).alias("n"), C.any_flag(["a", "b", "c"], ["own"]).alias("f")).collect()
    assert [(x.n, x.f) for x in r] == [(2, True), (0, False)]


def test_bin_between_and_order_map(spark):
    df = spark.createDataFrame([(0,), (2,), (9,)], "k int")
    lab, order = C.bin_between("k", [(0, 0, "none"), (1, 3, "some")])
    r = df.select(lab.alias("l"), order.alias("o"), C.order_by_map(F.lit("x"), ["a"]).alias("u")).collect()
    assert [(x.l, x.o, x.u) for x in r] == [("none", 1, None), ("some", 2, None), (None, None, None)]


def test_scenario_predicate_null_forms(spark):
    df = spark.createDataFrame([("own", "D"), ("own", None), (None, "D"), ("other", "D")], "src string, code string")
    strict = df.filter(P.scenario_ok("src", "code", "own", "D", null_safe=False)).count()
    safe = df.filter(P.scenario_ok("src", "code", "own", "D", null_safe=True)).count()
    assert strict == 1   # NULL operands drop the row
    assert safe == 3


def test_cum_product_null_rate_and_rebase(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 0.1), ("a", 3, 0.2)], "s string, y int, r double")
    out = df.select("y", (W.cum_product("r", ["s"], "y") * 100).alias("i")).orderBy("y").collect()
    assert [round(x.i, 6) for x in out] == [100.0, 110.0, 132.0]
    reb = df.withColumn("i", W.cum_product("r", ["s"], "y") * 100).select(
        "y", W.rebase_at("i", ["s"], "y", 2).alias("b")).orderBy("y").collect()
    assert round(reb[2].b, 6) == 120.0


def test_rank_abs_tie_break(spark):
    df = spark.createDataFrame([("g", "b", -2.0), ("g", "a", 2.0), ("g", "c", 1.0)], "g string, s string, e double")
    out = df.select("s", W.rank_abs("e", ["g"], tie=["s"]).alias("rn")).orderBy("rn").collect()
    assert [x.s for x in out] == ["a", "b", "c"]


# ---------------------------------------------------------------- foj_dupes: R8 property test
def _random_frame(spark, rnd, name, n):
    data = [(rnd.choice([None, 1, 2, 3, 4, 5]), float(rnd.randint(0, 9))) for _ in range(n)]
    return spark.createDataFrame(data, f"k int, {name} double"), data


@pytest.mark.parametrize("seed", [1, 2, 3, 4, 5])
def test_star_union_form_equals_chain(spark, seed):
    rnd = random.Random(seed)
    base, _ = _random_frame(spark, rnd, "b", rnd.randint(0, 6))
    others = [_random_frame(spark, rnd, f"v{i}", rnd.randint(0, 6))[0] for i in range(3)]
    for keys in ("coalesce", "base"):
        union = J.star_full_outer(base, others, ["k"], keys=keys, method="union")
        chain = J.star_full_outer(base, others, ["k"], keys=keys, method="chain")
        cols = ["k", "b", "v0", "v1", "v2"]
        assert rows(union, cols) == rows(chain, cols)


def test_indicator_merge_null_and_duplicate_keys(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n"), (2, "c")], "k int, l string")
    right = spark.createDataFrame([(1, 10), (3, 30), (None, 99)], "k int, r int")
    out = J.indicator_merge(left, right, ["k"])
    got = rows(out, ["k", "l", "r", "_merge"])
    assert got == rows(spark.createDataFrame(
        [(1, "a", 10, "both"), (1, "b", 10, "both"), (None, "n", None, "left_only"), (2, "c", None, "left_only"),
         (3, None, 30, "right_only"), (None, None, 99, "right_only")], "k int, l string, r int, _merge string"))


# ---------------------------------------------------------------- not_in_null
@pytest.mark.parametrize("listed,expected", [
    ([("x",), ("y",)], ["z"]),             # plain list: a NULL key is unknown -> dropped
    ([("x",), (None,)], []),               # list with NULL: nothing passes
    ([], ["x", "y", "z", None]),           # empty list: everything passes
])
def test_exclude_listed_not_in_semantics(spark, listed, expected):
    df = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "c string")
    lst = spark.createDataFrame(listed, "m string")
    got = sorted((r.c for r in J.exclude_listed(df, "c", lst, "m").collect()), key=lambda v: (v is None, v))
    assert got == sorted(expected, key=lambda v: (v is None, v))
    # same answer as SQL NOT IN in DuckDB
    con = duckdb.connect()
    con.execute("CREATE TABLE d(c VARCHAR)")
    con.execute("INSERT INTO d VALUES ('x'), ('y'), ('z'), (NULL)")
    con.execute("CREATE TABLE l(m VARCHAR)")
    for (m,) in listed:
        con.execute("INSERT INTO l VALUES (?)", [m])
    want = sorted((r[0] for r in con.execute("SELECT c FROM d WHERE c NOT IN (SELECT m FROM l)").fetchall()),
                  key=lambda v: (v is None, v))
    assert got == want


# ---------------------------------------------------------------- R9 grouping sets == union of aggregates
def test_with_totals_equals_union_of_aggregates(spark):
    rnd = random.Random(7)
    data = [(rnd.choice(["a", "b", None]), rnd.choice(["x", "y"]), float(rnd.randint(0, 9))) for _ in range(40)]
    df = spark.createDataFrame(data, "d1 string, d2 string, v double")
    got = A.with_totals(df, [], ["d1", "d2"], [F.sum("v").alias("s"), F.count(F.lit(1)).alias("n")])
    con = duckdb.connect()
    con.execute("CREATE TABLE t(d1 VARCHAR, d2 VARCHAR, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", data)
    want = con.execute("""
        SELECT d1, d2, sum(v), count(*) FROM t GROUP BY d1, d2
        UNION ALL SELECT 'Total', d2, sum(v), count(*) FROM t GROUP BY d2
        UNION ALL SELECT d1, 'Total', sum(v), count(*) FROM t GROUP BY d1
        UNION ALL SELECT 'Total', 'Total', sum(v), count(*) FROM t""").fetchall()
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted((tuple(r) for r in got.select("d1", "d2", "s", "n").collect()), key=key) == sorted(want, key=key)


# ---------------------------------------------------------------- R7 one-scan configs == UNION ALL arms
def test_for_each_config_equals_union_arms(spark):
    rnd = random.Random(3)
    data = [(rnd.choice(["g1", "g2", "g3"]), rnd.choice(["A", "B"]), float(rnd.randint(0, 9))) for _ in range(30)]
    df = spark.createDataFrame(data, "g string, t string, v double")
    configs = [{"name": "onlyA", "filter": F.col("t") == "A"}, {"name": "big", "filter": F.col("v") > 6},
               {"name": "none", "filter": F.col("v") > 100}]
    got = R.for_each_config(df, ["g"], configs, lambda c: [("m", F.avg(R.when_cfg(c, "v")))])
    arms = [df.filter(c["filter"]).groupBy("g").agg(F.avg("v").alias("m")).withColumn("config", F.lit(c["name"]))
            for c in configs]
    naive = arms[0].unionByName(arms[1]).unionByName(arms[2])
    assert rows(got, ["g", "config", "m"]) == rows(naive, ["g", "config", "m"])


# ---------------------------------------------------------------- windows / shares
def test_share_total_and_by_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 4.0)], "g string, x double")
    tot = [round(r.share, 6) for r in W.share(df, "x").orderBy("x").collect()]
    grp = [round(r.share, 6) for r in W.share(df, "x", ["g"]).orderBy("x").collect()]
    assert tot == [0.125, 0.375, 0.5]
    assert grp == [0.25, 0.75, 1.0]


def test_box_stats_whiskers(spark):
    df = spark.createDataFrame([("g", float(v)) for v in [1, 2, 3, 4, 100]], "g string, v double")
    r = A.box_stats(df, ["g"], "v").first()
    assert (r.q1, r.median, r.q3) == (2.0, 3.0, 4.0)
    assert (r.whisker_low, r.whisker_high, r.n_outliers) == (1.0, 4.0, 1)


def test_cross_scalar_has_no_cartesian(spark):
    df = spark.range(5)
    one = spark.range(3).agg(F.max("id").alias("m"))
    out = J.cross_scalar(df, one)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert {r.m for r in out.collect()} == {2}


# ---------------------------------------------------------------- exact percentiles at scale
@pytest.mark.parametrize("accuracy,max_window,bins", [(50, 1_000_000, 4096), (100_000, 1_000_000, 4096),
                                                      (50, 40, 8), (100_000, 25, 4)])
def test_bracketed_percentiles_equal_builtin(spark, accuracy, max_window, bins):
    from panelmart.operators import percentiles as PC

    rnd = random.Random(11)
    # one hot group with a third of the rows, many ties, NULLs and a tiny group
    data = [("hot", float(rnd.randint(0, 500))) for _ in range(3000)]
    data += [(f"g{i % 7}", rnd.gauss(0, 100)) for i in range(6000)]
    data += [("tiny", 1.0), ("tiny", None), (None, 5.0), (None, 7.0)]
    data += [("same", 3.0) for _ in range(200)]  # one value repeated: a degenerate bracket
    df = spark.createDataFrame(data, "g string, v double")
    pcts = [PC.median("v", "med"), PC.percentile("v", 0.25, "q1"), PC.percentile("v", 0.9, "p90"),
            PC.median(F.col("v") * 2, "med2")]
    got = PC.percentile_table(df, ["g"], pcts, accuracy=accuracy, max_window=max_window, bins=bins)
    want = df.groupBy("g").agg(*[p.builtin() for p in pcts])
    key = lambda t: tuple((x is None, str(x)) for x in t)
    g = sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in got.select("g", "med", "q1", "p90", "med2").collect()), key=key)
    w = sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in want.select("g", "med", "q1", "p90", "med2").collect()), key=key)
    assert g == w


def test_aggregate_grouping_sets_with_medians(spark):
    from panelmart.operators import percentiles as PC

    rnd = random.Random(5)
    data = [(rnd.choice(["a", "b", None]), rnd.choice(["x", "y"]), float(rnd.randint(0, 50))) for _ in range(300)]
    df = spark.createDataFrame(data, "d1 string, d2 string, v double")
    aggs = [A.median_of("v", "m"), F.count(F.lit(1)).alias("n"),
            A.median_change("v", F.col("v") / 2, "difference_of_medians", "dm")]
    spark.conf.set(PC.METHOD_CONF, "bracketed")
    try:
        got = A.with_totals(df, [], ["d1", "d2"], aggs)
        spark.conf.set(PC.METHOD_CONF, "builtin")
        want = A.with_totals(df, [], ["d1", "d2"], aggs)
        key = lambda t: tuple((x is None, str(x)) for x in t)
        cols = ["d1", "d2", "m", "n", "dm"]
        assert sorted(map(tuple, got.select(*cols).collect()), key=key) == sorted(map(tuple, want.select(*cols).collect()), key=key)
    finally:
        spark.conf.unset(PC.METHOD_CONF)


def test_driver_bridge_ranks_unions_orders_and_remainder(spark):
    from panelmart.plans.bridge import driver_bridge

    eff = spark.createDataFrame([("A", "s1", 10.0), ("A", "s2", -30.0), ("A", "s3", 5.0),
                                 ("B", "s1", 40.0), ("B", "s2", 1.0), ("B", "s3", -2.0)], "g string, step string, d double")
    base = spark.createDataFrame([("A", 100.0), ("B", 100.0)], "g string, b double")
    total = spark.createDataFrame([("A", -0.10), ("B", 0.50)], "g string, t double")
    out = {(r.g, r.step): r for r in driver_bridge(eff, "g", "step", "d", base, "b", total, "t", 1,
                                                   zero=[("B", "s2")]).collect()}
    # top-1 per group: A -> s2 (|-0.30|), B -> s1 (0.40); union {s1, s2} ordered by mean |effect|
    assert out[("A", "s1")].step_order == 1 and out[("A", "s2")].step_order == 2
    assert round(out[("A", "s2")].cumulative, 9) == round(0.10 - 0.30, 9)
    assert out[("B", "s2")].effect == 0.0                       # zeroed after ordering
    assert out[("A", "Other changes")].step_order == 3
    assert round(out[("A", "Other changes")].effect, 9) == round(-0.10 - (0.10 - 0.30), 9)


@pytest.mark.parametrize("listed", [[("m", "x")], [("m", "x"), ("m", None)], [], [("other", "x")]])
def test_with_exclusions_not_in_semantics(spark, listed):
    from panelmart.plans.overrides import OverrideConfig, with_exclusions

    df = spark.createDataFrame([("x",), ("y",), (None,)], "company string")
    ex = spark.createDataFrame(listed, "measure string, company string")
    out = with_exclusions(df, "company", ex, [OverrideConfig("c", "m", "m_prev")])
    got = sorted(((r["company"], r["__ok_c"]) for r in out.collect()), key=lambda t: (t[0] is None, t[0] or ""))
    con = duckdb.connect()
    con.execute("CREATE TABLE d(company VARCHAR)")
    con.execute("INSERT INTO d VALUES ('x'), ('y'), (NULL)")
    con.execute("CREATE TABLE l(measure VARCHAR, company VARCHAR)")
    for m, c in listed:
        con.execute("INSERT INTO l VALUES (?, ?)", [m, c])
    want = con.execute("SELECT company, coalesce(company NOT IN (SELECT company FROM l WHERE measure = 'm'), false) "
                       "FROM d").fetchall()
    assert got == sorted(want, key=lambda t: (t[0] is None, t[0] or ""))


def test_rounding_does_not_saturate(spark):
    import duckdb

    from panelmart.functions.columns import bround, fround, sql_bround, sql_fround

    values = [1.25, -3.75, 1e9 + 0.1, 1e13, 3e9, 2.0e15, 9.3e18, 1e20, -1e25, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 4, 8):
        got = [tuple(r) for r in df.select(fround("v", digits), bround("v", 4 * digits)).collect()]
        con = duckdb.connect()
        con.execute("CREATE TABLE t(i INTEGER, v DOUBLE)")
        con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
        want = con.execute(f"SELECT {sql_fround('v', digits)}, {sql_bround('v', 4 * digits)} FROM t ORDER BY i").fetchall()
        assert got == want
        assert all(abs(a - v) <= 10**-digits for (a, _), v in zip(got, values) if v is not None)


def test_clashing_columns_raise(spark):
    left, right = spark.createDataFrame([(1, "L")], "k int, v string"), spark.createDataFrame([(1, "R")], "k int, v string")
    with pytest.raises(ValueError, match="'v'"):
        J.indicator_merge(left, right, ["k"])
    assert J.indicator_merge(left, right, ["k"], drop_right=["v"]).first().v == "L"


def test_size_proof_sees_the_data_as_it_is(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(10).write.parquet(path)
    assert J.fits(spark.read.parquet(path), 100)
    spark.range(1000).write.mode("overwrite").parquet(path)
    assert not J.fits(spark.read.parquet(path), 100)


def test_product_of_rates_at_and_below_minus_one(spark):
    from panelmart.operators.windows import cum_product

    df = spark.createDataFrame([("a", 1, 0.1), ("a", 2, -1.0), ("a", 3, 0.5), ("b", 1, 0.1), ("b", 2, -1.5), ("b", 3, None)],
                               "s string, t int, r double")
    got = [(x.s, x.t, None if x.p is None else round(x.p, 9)) for x in df.withColumn("p", cum_product("r", ["s"], "t")).orderBy("s", "t").collect()]
    assert got == [("a", 1, 1.1), ("a", 2, 0.0), ("a", 3, 0.0), ("b", 1, 1.1), ("b", 2, None), ("b", 3, None)]


def test_even_split_is_not_ranked_row_by_row(spark):
    from panelmart.operators import percentiles as Q

    df = spark.range(4000).select(F.lit("g").alias("g"), F.when(F.col("id") % 2 == 0, 1.0).otherwise(2.0).alias("v"))
    out = Q.percentile_table(df, ["g"], [Q.median("v", "m"), Q.percentile("v", 0.9, "q")], accuracy=100, max_window=50).first()
    assert (out.m, out.q) == (1.5, 2.0)


def test_history_of_the_current_year(spark):
    from panelmart.operators.sets import prefer_current

    cur = spark.createDataFrame([("a", 2000, 1.0)], "s string, t int, v double")
    hist = spark.createDataFrame([("a", 1999, 2.0), ("a", 2000, 3.0), ("b", 2000, 4.0), ("b", 2001, 5.0)], "s string, t int, v double")
    got = sorted(tuple(r) for r in prefer_current(cur, hist, ["s", "t"], "t", 2000).collect())
    assert got == [("a", 1999, 2.0), ("a", 2000, 1.0), ("b", 2000, 4.0)]


def test_small_dim_broadcasts_only_behind_the_row_bound(spark):
    big = spark.range(5000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    assert J.fits(small, 10) and not J.fits(big, 100)
    assert J.fits(small, 10, incremental=True) and not J.fits(big, 100, incremental=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = big.join(J.small_dim(small, 100), ["k"])
        plain = big.join(J.small_dim(big.select("k"), 100), ["k"])
        assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
