from decimal import Decimal

from pyspark.sql import functions as F

from cabstrata.operators import profile

ACCEPTED = {"a": profile.Domain(("9",), 0, 9)}


def table(spark, rows):
    return spark.createDataFrame([(b, by, None if v is None else Decimal(v)) for b, by, v in rows], "b string, l string, a decimal(10,2)").withColumn("mask", F.lit(1))


def run(spark, rows):
    return profile.profile_from_counts(profile.value_counts(table(spark, rows), "b", "l", ["a"]), ACCEPTED)


def test_masks_and_texts(spark):
    df = spark.createDataFrame([("Ab-9é",), (None,), ("",)], "t string").select(profile.mask(F.col("t")).alias("m"))
    assert [r.m for r in df.collect()] == ["Aa-9a", None, ""]
    d = spark.createDataFrame([(Decimal("1.00"),), (Decimal("0.50"),), (Decimal("10.00"),), (None,)], "a decimal(10,2)")
    assert [r[0] for r in d.select(profile.canonical_text(F.col("a"), "decimal(10,2)")).collect()] == ["1", "0.5", "10", None]


def test_issues_against_the_load_before_of_the_same_loader(spark):
    rows = [("b1", "x", "1")] * 10 + [("b2", "y", "5")] * 10 + [("b3", "x", "1")] * 7 + [("b3", "x", None)] * 3 + [("b4", "x", "2")] * 9 + [("b4", "x", "1.5")]
    got = {(r.batch_id, r.issue) for r in profile.load_issues(run(spark, rows)).collect()}
    # b2 is another loader's first; b3 has 30 % nulls after none; b4 has other values, fewer nulls and a broken one.
    assert got == {("b3", "nulls"), ("b4", "nulls"), ("b4", "shift"), ("b4", "values")}


def test_thresholds_are_exclusive(spark):
    rows = [("b1", "x", "1")] * 97 + [("b1", "x", "1.5")] * 3
    assert profile.load_issues(run(spark, rows)).count() == 0
    rows = [("b1", "x", "1")] * 10 + [("b2", "x", "1")] * 8 + [("b2", "x", "2")] * 2
    assert profile.load_issues(run(spark, rows)).count() == 0


def test_null_columns_null_loads_and_empty_tables(spark):
    got = run(spark, [("b1", "x", None), ("b1", "x", None), (None, "x", "3"), ("b2", None, "1")]).collect()
    assert {(r.batch_id, r.n_rows, r.n_null, r.n_distinct) for r in got} == {("b1", 2, 2, 0), (None, 1, 0, 1), ("b2", 1, 0, 1)}
    assert run(spark, []).count() == 0
    assert profile.mask_profile(profile.mask_counts(table(spark, []), "b", "l", ["a"])).count() == 0


def test_mask_profile(spark):
    rows = [("b1", "x", "1")] * 99 + [("b1", "x", "-7")] + [("b2", "x", "22")] * 100
    got = {r.batch_id: r for r in profile.mask_profile(profile.mask_counts(table(spark, rows), "b", "l", ["a"])).collect()}
    assert got["b1"].dominant_mask == "9" and got["b1"].n_rare_mask == 1 and got["b1"].mask_divergence is None
    assert got["b2"].dominant_mask == "99" and got["b2"].mask_divergence == 1.0
    lo = {r.batch_id: (r.least, r.greatest, r.n_null) for r in profile.range_profile(table(spark, rows), "b", ["a"]).collect()}
    assert lo["b1"] == ("-7.00", "1.00", 0)


def test_masks_judge_before_values(spark):
    rows = [("b1", "x", "1")] * 90 + [("b1", "x", "77")] * 9 + [("b1", "x", "-3")] + [("b2", "x", "2")] * 70 + [("b2", "x", "88")] * 30
    counts = profile.value_counts(table(spark, rows), "b", "l", ["a"])
    got = {r.batch_id: r for r in profile.profile_from_counts(counts, {"a": profile.Domain(("9",), 2, 6)}).collect()}
    assert (got["b1"].n_other_mask, got["b1"].n_outside, got["b1"].n_rare_mask) == (10, 90, 1) and (got["b2"].n_other_mask, got["b2"].n_outside) == (30, 0)
    assert round(got["b2"].mask_divergence, 9) == 0.21 and got["b2"].value_divergence == 1.0
    assert "mask" in profile.load_issues(profile.profile_from_counts(counts, ACCEPTED))._jdf.queryExecution().optimizedPlan().toString()
    patterns = {r.mask: (r.n_rows, r.place, r.rare) for r in profile.column_patterns(counts).collect()}
    assert patterns == {"9": (160, 1, False), "99": (39, 2, False), "-9": (1, 3, True)}


def test_distinct_estimates(spark):
    rows = [("b1", "x", str(i % 700)) for i in range(3000)] + [("b2", "x", None)]
    got = {r.batch_id: r.approx_distinct for r in profile.distinct_profile(table(spark, rows), "b", ["a"]).collect()}
    assert abs(got["b1"] - 700) <= 3 * 0.02 * 700 and got["b2"] == 0
