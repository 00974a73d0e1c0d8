from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cabstrata.operators import skew
from cabstrata.operators.sizing import lookup_join


def naive(left, right, how):
    out = {}
    for k, r, x in left:
        partners = [y for q, y in right if q == k and k is not None]
        if not partners and how == "left":
            partners = [None]
        for y in partners:
            o = out.setdefault(r, [0, None, None])
            o[0] += 1
            o[1] = o[1] if x is None else (o[1] or 0) + x
            o[2] = o[2] if y is None else (o[2] or 0) + y
    return {k: tuple(v) for k, v in out.items()}


key = st.one_of(st.none(), st.integers(0, 3))
val = st.one_of(st.none(), st.integers(-5, 5))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(key, st.sampled_from("ab"), val), max_size=12), st.lists(st.tuples(key, val), max_size=12), st.sampled_from(["inner", "left"]))
def test_equals_the_join_itself(spark, left, right, how):
    a = spark.createDataFrame(left, "k int, r string, x bigint").withColumn("y", F.lit("clashing name"))
    b = spark.createDataFrame(right, "k int, y bigint").withColumn("x", F.lit("clashing name"))
    got = skew.eager_join_aggregate(a, b.withColumnRenamed("y", "z"), ["k"], ["r"], left_by=["r"], left_sums={"x": F.col("x")}, right_sums={"z": F.col("z")}, how=how)
    assert {r.r: (r.joined_rows, r.x, r.z) for r in got.collect()} == naive(left, right, how)


def test_heavy_keys(spark):
    rows = [(1,)] * 6 + [(2,)] * 3 + [(None,)] * 11
    states = skew.compact(spark.createDataFrame(rows, "k int"), ["k"])
    assert [r.k for r in skew.heavy_keys(states, "k", "_n", 0.2).collect()] == [1]
    assert skew.heavy_keys(states.limit(0), "k", "_n", 0.2).count() == 0


def test_lookup_join_gives_the_same_when_the_side_is_too_large(spark):
    big = spark.createDataFrame([(k, i) for i in range(60) for k in (0, 0, i % 7, None)], "k int, i int")
    small = spark.createDataFrame([(k, k * 10) for k in range(5)], "k int, v int")
    for how in ("inner", "left"):
        a = lookup_join(big, small, ["k"], ["i"], how)
        b = lookup_join(big, small, ["k"], ["i"], how, max_rows=2)
        assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.select(a.columns).collect()))
