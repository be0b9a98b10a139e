"""Funnel annotation vs the naive nested-step form (FIXTURES funnel_mixed, buckets_edge)."""

from pyspark.sql import functions as F

from support import rows
from panelmart.plans import funnel as FN


def _units(spark):
    data = []
    # company A: mean flag exactly at the threshold -> fails the strict '>' test
    data += [("A", "k1", "t", 0.5, 1.0) for _ in range(2)] + [("A", "k1", "t", 1.0, 1.0) for _ in range(2)]
    # company B: passes; complex k2 has one excluded unit type -> whole complex dropped
    data += [("B", "k2", "bad", 1.0, 1.0), ("B", "k2", "t", 1.0, 1.0)] + [("B", "k3", "t", 1.0, 2.0) for _ in range(4)]
    # company C: passes, NULL complex (anti-join semantics keep it), exactly min_rows units -> fails '>'
    data += [("C", None, "t", 1.0, 1.0) for _ in range(3)]
    # company D: passes everything, one row with a NULL value dropped by the row filter
    data += [("D", "k4", "t", 1.0, 5.0) for _ in range(5)] + [("D", "k4", "t", 1.0, None)]
    return spark.createDataFrame(data, "company string, complex string, unit_type string, flag double, value double")


def steps():
    return [
        FN.GroupMean("mean flag", ["company"], "flag", 0.75),
        FN.ExcludeGroups("no bad complexes", ["company", "complex"], F.col("unit_type") == "bad"),
        FN.RowFilter("value known", F.col("value") > 0),
        FN.GroupCount("min units", ["company"], 3),
    ]


def _naive(df):
    steps = [df]
    m = df.groupBy("company").agg(F.avg("flag").alias("m")).filter("m > 0.75")
    s1 = df.join(m.select("company"), ["company"], "left_semi")
    bad = s1.filter(F.col("unit_type") == "bad").select("company", "complex").distinct()
    s2 = s1.join(bad, ["company", "complex"], "left_anti")
    s3 = s2.filter(F.col("value") > 0)
    c = s3.groupBy("company").count().filter("count > 3").select("company")
    s4 = s3.join(c, ["company"], "left_semi")
    steps += [s1, s2, s3, s4]
    return steps


def test_funnel_matches_nested_steps(spark):
    df = _units(spark)
    ann = FN.validation_funnel(df, steps())
    naive = _naive(df)
    cols = ["company", "complex", "unit_type", "flag", "value"]
    for i, step_df in enumerate(naive):
        assert rows(ann.filter(F.col(FN.STAGE) >= i), cols) == rows(step_df, cols)
    assert sorted(r.company for r in FN.funnel_result(ann, 4).select("company").distinct().collect()) == ["B", "D"]


def test_funnel_stats_counts_and_empty_steps(spark):
    df = _units(spark)
    ann = FN.validation_funnel(df, steps() + [FN.GroupCount("impossible", ["company"], 10_000)])
    labels = ["start", "mean flag", "no bad complexes", "value known", "min units", "impossible"]
    stats = {r.step: r for r in FN.funnel_stats(ann, labels, "company", "complex", "unit_type", "value", scale=1.0).collect()}
    assert stats["start"].n_units == 19 and stats["start"].n_companies == 4
    assert stats["mean flag"].n_companies == 3          # A (mean exactly 0.75) is out
    assert stats["min units"].n_companies == 2          # C has exactly 3 units: not more than 3
    assert stats["impossible"].n_units == 0 and stats["impossible"].value_bn is None
    # concat-based distinct counts drop rows with a NULL part (C's NULL complex)
    assert stats["start"].n_sub_companies == 4


def test_deviation_buckets_edges_and_completion(spark):
    dev = spark.createDataFrame([("a", -0.3, 2), ("b", -0.25, 3), ("c", 0.0, 1), ("d", 0.25, 4), ("e", None, 5)],
                                "g string, d double, n long")
    edges, labels = [-0.25, 0.0, 0.25], ["lt", "m25_0", "0_25", "ge"]
    domain = spark.createDataFrame([(lab, i) for i, lab in enumerate(labels, start=1)], "bucket string, bucket_order int")
    out = {r.bucket: r for r in FN.deviation_buckets(dev, "d", "n", edges, labels, domain).collect()}
    assert (out["lt"].n_groups, out["m25_0"].n_groups, out["0_25"].n_groups, out["ge"].n_groups) == (1, 1, 1, 2)
    assert out["ge"].n_units == 9 and round(out["ge"].share_units, 6) == round(9 / 15, 6)
