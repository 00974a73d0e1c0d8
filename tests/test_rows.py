from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cabstrata.functions import keys, scalars
from cabstrata.operators import classify, dedupe, dq, enrich, scd2, union, upsert, windows

S = "k string, v int, w int"


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_minutes(spark):
    a, b = datetime(2024, 1, 1, 0, 0, 50), datetime(2024, 1, 1, 0, 1, 10)
    df = spark.createDataFrame([(a, b), (None, b)], "a timestamp_ntz, b timestamp_ntz")
    got = df.select(scalars.minutes_boundary(F.col("a"), F.col("b")), F.round(scalars.minutes_fractional(F.col("a"), F.col("b")), 3), scalars.iso_weekday(F.to_date("a"))).collect()
    assert tuple(got[0]) == (1, 0.333, 1) and tuple(got[1]) == (None, None, None)


def test_rounding_and_bins(spark):
    df = spark.createDataFrame([(2.675,), (1.0,), (20.0,), (20.1,), (None,)], "x double")
    assert [r[0] for r in df.select(scalars.rounded(F.col("x"), 2)).collect()][0] == 2.68
    from cabstrata.plans.marts import distance_bucket

    assert [r[0] for r in df.select(distance_bucket(F.col("x"))).collect()] == ["1-3mi", "0-1mi", "10-20mi", "20mi+", "20mi+"]


def test_keys(spark):
    df = spark.createDataFrame([(1, None), (None, 1)], "a int, b int")
    h = [r.h for r in df.select(keys.row_hash(["a", "b"]).alias("h")).collect()]
    assert h[0] != h[1]
    k = [r.k for r in df.select(keys.surrogate_key(F.col("a"), F.col("b")).alias("k")).collect()]
    assert k[0] != k[1] and None not in k
    n = spark.createDataFrame([("/a//B.parquet ", 'W/"X-2"'), (None, None)], "n string, e string").select(keys.bare_name(F.col("n")), keys.bare_etag(F.col("e"))).collect()
    assert tuple(n[0]) == ("b.parquet", "x-2") and tuple(n[1]) == (None, None)


def test_ladder(spark):
    ladder = dedupe.Ladder(["-v"], ["w > 0"], ["w"])
    df = spark.createDataFrame([("a", 1, 1), ("a", None, 9), ("a", 2, None), ("a", 2, -1), ("a", 2, 5), ("a", 2, 3), (None, 1, 1), (None, 1, 1)], S)
    assert sorted(map(tuple, dedupe.dedupe_natural_key(df, ladder, ["k"]).collect()), key=str) == [("a", 2, 3), (None, 1, 1)]
    assert dedupe.dedupe_natural_key(df.limit(0), ladder, ["k"]).count() == 0


def test_first_rule_wins_and_unknown_is_no_match(spark):
    rules = [classify.Rule("low", "v < 0"), classify.Rule("odd", "v % 2 = 1 or w is null")]
    df = classify.classify(spark.createDataFrame([("a", -1, 1), ("b", 2, None), ("c", None, 1), ("d", 3, 1)], S), rules)
    assert {(r.k, r.invalid_reason, r.is_valid) for r in df.collect()} == {("a", "low", False), ("b", "odd", False), ("c", None, True), ("d", "odd", False)}
    good, bad = classify.split(df)
    assert good.count() + bad.count() == 4


@pytest.mark.parametrize(
    ("changes", "reason"),
    [
        ({}, None), ({"pickup_ts": None}, "null_timestamp"), ({"dropoff_ts": datetime(2024, 1, 1)}, "pickup_ge_dropoff"), ({"trip_duration_min": 720.0}, None), ({"trip_duration_min": 720.1}, "duration_out_of_range"),
        ({"trip_distance": 0.0}, "non_positive_distance"), ({"trip_distance": None}, "non_positive_distance"), ({"trip_distance": 200.0}, None), ({"trip_distance": 200.01}, "distance_out_of_range"),
        ({"fare_amount": -0.01}, "negative_fare_or_total"), ({"fare_amount": 0.0, "tip_amount": 0.0}, None), ({"total_amount": 1000.01}, "excessive_fare_or_total"), ({"tip_amount": 10.0}, None), ({"tip_amount": 10.01}, "tip_exceeds_fare_or_total"),
        ({"fare_amount": None, "tip_amount": None, "total_amount": None}, None), ({"payment_type": 0}, "unknown_payment_type"), ({"payment_type": None}, None), ({"do_location_id": None}, "null_location_id"), ({"dup_rank": 2}, "duplicate_row"),
        ({"trip_distance": 0.0, "payment_type": 0}, "non_positive_distance"),
    ],
)
def test_trip_rules(spark, changes, reason):
    base = {"pickup_ts": datetime(2024, 1, 1), "dropoff_ts": datetime(2024, 1, 1, 1), "trip_duration_min": 60.0, "trip_distance": 2.0, "fare_amount": 10.0, "total_amount": 20.0, "tip_amount": 1.0, "payment_type": 1, "pu_location_id": 1, "do_location_id": 1, "dup_rank": 1}
    schema = "pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, trip_duration_min double, trip_distance double, fare_amount double, total_amount double, tip_amount double, payment_type int, pu_location_id int, do_location_id int, dup_rank int"
    r = base | changes
    assert classify.classify(spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", "))], schema)).head().invalid_reason == reason


def test_roles(spark):
    trips = spark.createDataFrame([(1, 1, 2), (2, 9, None)], "id int, pu int, do int")
    zones = spark.createDataFrame([(1, "A"), (2, "B"), (None, "N")], "location_id int, zone_name string")
    got = enrich.lookup_roles(trips, zones, "location_id", {"pu": {"zone_name": "pz"}, "do": {"zone_name": "dz"}})
    assert rows(got.select("id", "pz", "dz")) == {(1, "A", "B"), (2, None, None)}


def test_upserts(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 2), (None, 3, 3)], S)
    new = spark.createDataFrame([("b", 9, 9), ("c", 8, 8), (None, 7, 7)], S)
    want = {("a", 1, 1), ("b", 9, 9), ("c", 8, 8), (None, 7, 7)}
    assert rows(upsert.merge_upsert(old, new, ["k"])) == want
    assert rows(upsert.merge_upsert(upsert.merge_upsert(old, new, ["k"]), new, ["k"])) == want
    assert rows(upsert.delete_insert(old, new, ["k"])) == want
    assert rows(upsert.replace_scope(old, new, "v >= 2")) == {("a", 1, 1), ("b", 9, 9), ("c", 8, 8), (None, 7, 7)}
    assert upsert.synced(old, ["k", "z"]).columns == ["k", "z"]
    wide = upsert.merge_upsert(old, new.withColumn("z", F.lit(1)), ["k"])
    assert wide.where("z is null").count() == 1
    f = spark.createDataFrame([("X/a.parquet",), ("b.parquet",), (None,)], "f string")
    assert rows(upsert.delete_by_file(f, "A.parquet", "f")) == {("b.parquet",), (None,)}


def test_scd2(spark):
    t1, t2, t3 = (f"2024-01-0{i} 00:00:00" for i in (1, 2, 3))
    d1, d2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    h = scd2.scd2_start(spark.createDataFrame([("a", 1, 1), ("b", None, 1), ("c", 1, None)], S), t1)
    new = spark.createDataFrame([("a", 1, 2), ("b", 5, 1), ("c", 1, None), ("d", 1, 1)], S)
    h2 = scd2.scd2_apply(h, new, "k", ["v"], t2)
    want = {("a", 1, 1, d1, None), ("b", None, 1, d1, d2), ("b", 5, 1, d2, None), ("c", 1, None, d1, None), ("d", 1, 1, d2, None)}
    assert rows(h2) == want
    assert rows(scd2.scd2_apply(h2, new, "k", ["v"], t3)) == want
    assert scd2.scd2_overlaps(h2, "k").count() == 0 and scd2.scd2_overlaps(h.unionByName(h), "k").count() == 3


def test_priority_union(spark):
    a, b = spark.createDataFrame([("a", 1, 1)], S), spark.createDataFrame([("a", 2, 2), ("b", 3, 3), (None, 4, 4)], S)
    assert rows(union.priority_union({"live": a, "old": b}, ["k"])) == {("live", "a", 1, 1), ("old", "b", 3, 3), ("old", None, 4, 4)}


def test_windows(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 3, 0), ("b", 1, 1)], S)
    assert rows(windows.top_k(df, ["k"], [F.col("w").desc()], 1).select("k", "v")) == {("a", 1), ("a", 2), ("b", 1)}
    assert rows(windows.qualify(df, F.col("v") > 1).select("v")) == {(2,), (3,)}
    assert {(r.k, r.v, r.p) for r in windows.shifted(df, ["k"], ["v"], "v", "p").collect()} == {("a", 1, None), ("a", 2, 1), ("a", 3, 2), ("b", 1, None)}


def test_dq(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, None), (None, -1, 3), (None, None, 4)], S)
    assert dq.not_null(df, "k").count() == 2
    assert rows(dq.unique(df, ["k"])) == {("a", 2)}
    assert dq.accepted_values(df, "v", [1, 2]).count() == 1
    assert rows(dq.relationships(df, "w", spark.createDataFrame([(1,), (None,)], "p int"), "p").select("w")) == {(3,), (4,)}
    assert dq.in_range(df, "v", 0, 1).count() == 2 and dq.in_range(df, "v", 0, 1, only="k is null").count() == 1
    assert dq.duration_sane(df, "v", 1).count() == 3
    n = spark.createDataFrame([(2024, m) for m, c in ((1, 10), (2, 14), (3, 20), (4, 2)) for _ in range(c)], "y int, m int")
    assert [(r.m, r.prev_trip_count) for r in dq.period_counts(n, ["y", "m"], 0.4, 5).collect()] == [(3, 14)]
    mart = n.groupBy("y", "m").agg(F.count("*").alias("trip_count")).where("m != 4").withColumn("trip_count", F.when(F.col("m") == 1, 9).otherwise(F.col("trip_count")))
    assert {(r.m, r["diff"]) for r in dq.reconcile(n, mart, ["y", "m"], "x").collect()} == {(1, 1), (4, 2)}
    f = spark.createDataFrame([(datetime(2024, 1, 1),)], "t timestamp")
    assert [dq.freshness(x, "t", now).head().status for x, now in ((f, "2024-01-02"), (f, "2024-03-01"), (f, "2024-06-01"), (f.limit(0), "2024-01-02"))] == ["pass", "warn", "error", "error"]
    h = spark.createDataFrame([("a", None), ("a", datetime(2024, 1, 1)), ("b", None), ("b", None)], "k string, valid_to timestamp")
    assert rows(dq.one_current(h, "k")) == {("b", 2)}
