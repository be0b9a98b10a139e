"""Data-quality operators on frames with planted violations (SURVEY §5 strategy (4))."""

from pyspark.sql import functions as F

from panelmart.operators import quality as Q


def _df(spark):
    return spark.createDataFrame(
        [(1, "a", "F", 1, 0.5, 100.0, 90.0, 60.0, 30.0, "c1", "p1"),
         (1, "a", "X", 2, 1.5, 100.0, 120.0, 60.0, 30.0, "c2", None),
         (2, None, None, None, None, None, None, 1.0, 2.0, None, "p2"),
         (3, "c", "O", 0, -0.1, 50.0, 40.0, 20.0, 10.0, "c3", "p3")],
        "k long, name string, status string, flag int, rate double, market double, policy double, "
        "part_a double, part_b double, city string, province string")


def test_not_null_unique_and_mixed(spark):
    df = _df(spark)
    assert Q.not_null(df, ["name"]).count() == 1
    assert [r.k for r in Q.unique(df, ["k"]).collect()] == [1]
    un = {(r.key_value, r.issue) for r in Q.unique_not_null(df, "name").collect()}
    assert un == {("a", "duplicate"), (None, "null")}
    issues = sorted(r.issue for r in Q.mixed_checks(df, ["name"], "k").collect())
    assert issues == ["k not unique", "name is null"]


def test_accepted_binary_range_rule(spark):
    df = _df(spark)
    assert [r.status for r in Q.accepted_values(df, "status", ["F", "O"]).collect()] == ["X"]  # NULL passes
    assert [r.flag for r in Q.binary_flag(df, ["flag"]).collect()] == [2]
    assert sorted(r.rate for r in Q.in_range(df, "rate", 0.0, 1.0).collect()) == [-0.1, 1.5]
    assert [r.policy for r in Q.rule(df, F.col("policy") <= F.col("market")).collect()] == [120.0]


def test_components_implies_chain(spark):
    df = _df(spark)
    bad = Q.components_sum(df, "policy", [("part_a", 1), ("part_b", 1)], 0.01).select("k").collect()
    assert sorted(r.k for r in bad) == [1, 3]  # 90 = 60+30 passes; a NULL total is not a violation
    imp = Q.implies(df, F.col("status") == "F", F.col("flag") == 1).collect()
    assert imp == []
    chain = Q.chain_complete(df, "city", ["province"]).collect()
    assert [r.city for r in chain] == ["c2"]


def test_foreign_key_subset_monotonic_yoy(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (9,)], "pk long")
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    assert [r.pk for r in Q.foreign_key(child, parent, "pk", "id").collect()] == [9]  # NULL key is not an orphan
    assert [r.pk for r in Q.subset_of(child.filter("pk is not null"), parent.withColumnRenamed("id", "pk"), ["pk"]).collect()] == [9]
    steps = spark.createDataFrame([(0, 100), (1, 80), (2, 90), (3, 10)], "step int, n int")
    assert [r.step for r in Q.monotonic(steps, "step", "n").collect()] == [2]
    yoy = spark.createDataFrame([(1, 100.0, 50.0), (2, 100.0, 99.0), (3, 1.0, 0.0)], "k int, cur double, prev double")
    assert [r.k for r in Q.yoy_bounds(yoy, "cur", "prev", -0.5, 0.5).collect()] == [1]


def test_run_report_statuses(spark):
    df = _df(spark)
    report = Q.run_report([
        Q.Check("names", Q.not_null(df, ["name"])),
        Q.Check("keys", Q.unique(df, ["k"]), "warn", warn_if=2),
        Q.Check("status", Q.accepted_values(df, "status", ["F", "O"]), "warn"),
        Q.Check("clean", Q.not_null(df, ["k"])),
    ])
    got = {r.check_name: (r.violations, r.status) for r in report.collect()}
    assert got == {"names": (1, "fail"), "keys": (1, "pass"), "status": (1, "warn"), "clean": (0, "pass")}


def test_row_checks_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    _df(spark).write.parquet(path)
    df = spark.read.parquet(path)
    report = Q.run_report([
        Q.RowCheck("rate_range", df, (F.col("rate") < 0) | (F.col("rate") > 1)),
        Q.RowCheck("policy_rule", df, ~(F.col("policy") <= F.col("market")), "warn"),
        Q.Check("names", Q.not_null(df, ["name"])),
    ])
    plan = report._jdf.queryExecution().executedPlan().toString()   # before execution: the initial plan only
    assert plan.count("FileScan") == 2   # one scan for both row rules, one for the Check
    got = {r.check_name: (r.violations, r.status) for r in report.collect()}
    assert got == {"rate_range": (2, "fail"), "policy_rule": (1, "warn"), "names": (1, "fail")}


def test_checks_bite(spark):
    """Every check with natural violations in the test tables returns rows."""
    from panelmart.queries.quality_found_q import FOUND
    from panelmart.registry import REGISTRY

    for name in FOUND:
        assert not REGISTRY[name].spark(spark, "/root/testdata/sf0.001").isEmpty(), name
