import math
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cabstrata.llm import percentiles

Q = {"p10": "0.1", "p50": "0.5", "p70": "0.7", "p99": "0.99", "p100": "1"}
SCHEMA = "g string, part int, v double"


def brute(rows):
    out = {}
    for g in {r[0] for r in rows}:
        v = sorted(x for a, _, x in rows if a == g and x is not None and x == x)
        n = sum(1 for a, _, _ in rows if a == g)
        out[g] = (len(v), n - len(v), *[v[max(1, math.ceil(Fraction(q) * len(v))) - 1] if v else None for q in Q.values()])
    return out


def collected(df, groups=("g",)):
    return {r.g: (r.n_values, r.n_null, *[r[q] for q in Q]) for r in df.collect()}


row = st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 2), st.one_of(st.none(), st.just(float("nan")), st.integers(-3, 9).map(lambda i: i / 4)))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=30))
def test_equals_sorting_and_parts_add_up(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit("clash"), "value": F.lit(0)})
    state = percentiles.frequency_state(df, ["g"], "v")
    assert collected(percentiles.percentiles(state, ["g"], Q, range_rows=2)) == brute(rows)
    parts = percentiles.frequency_state(df.where("part = 0"), ["g"], "v").unionByName(percentiles.frequency_state(df.where("part > 0"), ["g"], "v"))
    assert collected(percentiles.percentiles(percentiles.merge_states(parts, ["g"]), ["g"], Q, range_rows=3)) == brute(rows)


def test_error_bound_holds(spark):
    rows = [("a", 0, i * 0.013) for i in range(500)]
    exact = collected(percentiles.percentiles(percentiles.frequency_state(spark.createDataFrame(rows, SCHEMA), ["g"], "v"), ["g"], Q))["a"]
    got = percentiles.percentiles(percentiles.frequency_state(spark.createDataFrame(rows, SCHEMA), ["g"], "v", 0.5), ["g"], Q, 0.5).head()
    assert got.error_bound == 0.25 and all(abs(got[q] - e) <= 0.25 + 1e-9 for q, e in zip(Q, exact[2:], strict=True))


def test_one_value_and_nothing(spark):
    df = spark.createDataFrame([("a", 0, 7.0)] * 1000 + [("b", 0, None)], SCHEMA)
    got = collected(percentiles.percentiles(percentiles.frequency_state(df, ["g"], "v"), ["g"], Q))
    assert got == {"a": (1000, 0, 7.0, 7.0, 7.0, 7.0, 7.0), "b": (0, 1, None, None, None, None, None)}
    assert percentiles.percentiles(percentiles.frequency_state(df.limit(0), ["g"], "v"), ["g"], Q).count() == 0


def test_ranges_of_a_group_are_even(spark):
    """A group with a narrow span beside a wide one, both of the same number of values: each is split by cuts
    of its own, the largest range within 1.5 times the even share."""
    rows = [("narrow", 0, 5 + i * 1e-6) for i in range(4000)] + [("wide", 0, float(i * i)) for i in range(4000)] + [("small", 0, 1.0)]
    state = percentiles.frequency_state(spark.createDataFrame(rows, SCHEMA), ["g"], "v")
    keyed = state.select(F.struct("g").alias("_key"), "value", "n")
    cuts = percentiles._cuts(keyed, keyed.groupBy("_key").agg(F.count("value").alias("_rows")), 500)
    assert sorted((r._key.g, len(r._cuts)) for r in cuts.collect()) == [("narrow", 7), ("wide", 7)]
    placed = keyed.join(cuts, "_key").withColumn("r", percentiles.range_number(F.col("value"), F.col("_cuts"), 7)).groupBy("_key", "r").count().collect()
    assert len(placed) == 16 and max(r["count"] for r in placed) <= 1.5 * 500
    assert collected(percentiles.percentiles(state, ["g"], Q, range_rows=500)) == brute(rows)


def test_stored_states_are_put_together(spark, tmp_path):
    rows = [("a", p, float(i % (5 + p))) for p in (0, 1, 2) for i in range(40)] + [(None, None, 3.0), ("b", 1, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    path = f"{tmp_path}/states"
    state = percentiles.frequency_state(df, ["g", "part"], "v")
    percentiles.store_state(state.where("part <= 1 or part is null"), path, "part")
    percentiles.store_state(state.where("part >= 1"), path, "part")
    stored = percentiles.stored_state(spark, path, state.schema)
    assert collected(percentiles.percentiles(percentiles.merge_states(stored, ["g"]), ["g"], Q)) == brute(rows)
    late = percentiles.merge_states(stored.where("part = 2"), ["g"])
    assert collected(percentiles.percentiles(late, ["g"], Q)) == brute([r for r in rows if r[1] == 2])
