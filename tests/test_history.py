from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cabstrata.operators import history

T0 = datetime(2024, 1, 1)


def brute(rows):
    out = set()
    for e in {r[0] for r in rows if r[0] is not None}:
        best = {}
        for _, d, a, b, load in sorted((r for r in rows if r[0] == e and r[1] is not None), key=lambda r: ((r[4] is not None, r[4] or 0), (r[2] is not None, r[2] or 0), (r[3] is not None, r[3] or 0))):
            best[d] = (a, b)
        versions = []
        for d in sorted(best):
            if not versions or versions[-1][1] != best[d]:
                versions.append((d, best[d]))
        for i, (d, v) in enumerate(versions):
            out.add((e, *v, d, versions[i + 1][0] if i + 1 < len(versions) else None, len(versions)))
    return out


def stamp(d):
    return None if d is None else T0 + timedelta(days=d)


row = st.tuples(st.sampled_from(["p", "q", None]), st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(0, 1)), st.one_of(st.none(), st.integers(0, 1)), st.one_of(st.none(), st.integers(0, 2)))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=14))
def test_equals_brute_force(spark, rows):
    df = spark.createDataFrame([(e, stamp(d), a, b, x) for e, d, a, b, x in rows], "e string, t timestamp_ntz, a int, b int, loaded int").withColumn("versions", F.lit("clash"))
    got = history.combined_history(df, "e", "t", ["a", "b"], [F.col("loaded")])
    want = {(e, a, b, stamp(f), stamp(u), n) for e, a, b, f, u, n in brute(rows)}
    assert {tuple(r) for r in got.select("e", "a", "b", "valid_from", "valid_to", "versions").collect()} == want
    one = history.attribute_history(df, "e", "t", "a", [F.col("loaded")])
    assert {(r.entity if "entity" in r else r.e, r.value, r.valid_from) for r in one.collect()} == {(e, a, stamp(f)) for e, a, _, f, _, _ in brute([(e, d, a, None, x) for e, d, a, b, x in rows])}


def combined_brute(a, b):
    out = set()
    for e in {r[0] for r in a + b}:
        cuts = sorted({t for r in a + b if r[0] == e for t in r[2:] if t is not None})
        said = []
        for t in cuts:
            now = tuple(next((r[1] for r in h if r[0] == e and r[2] <= t and (r[3] is None or t < r[3])), None) for h in (a, b))
            if not said or said[-1][1] != now:
                said.append((t, now))
        out |= {(e, *v, t, said[i + 1][0] if i + 1 < len(said) else None) for i, (t, v) in enumerate(said)}
    return out


@st.composite
def intervals(draw):
    out = []
    for e in ("p", "q"):
        cuts = sorted(draw(st.lists(st.integers(0, 9), unique=True, max_size=5)))
        for x, y in zip(cuts, [*cuts[1:], None], strict=False):
            if draw(st.booleans()):
                out.append((e, draw(st.one_of(st.none(), st.integers(0, 1))), x, y))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(intervals(), intervals())
def test_histories_of_two_sources(spark, a, b):
    schema = "e string, value int, valid_from int, valid_to int"
    ha, hb = (spark.createDataFrame(x + [(None, 1, 1, 2), ("z", 1, None, 3), ("z", 1, 4, 4)], schema).withColumn("b", F.lit("clash")) for x in (a, b))
    got = {tuple(r) for r in history.combine_histories({"a": ha, "b": hb}, "e").collect()}
    assert got == combined_brute(a, b)


def test_splits_and_coalesces(spark):
    schema = "e string, value int, valid_from int, valid_to int"
    ha = spark.createDataFrame([("p", 1, 0, 4), ("p", 1, 4, 6), ("p", 2, 6, None)], schema)
    hb = spark.createDataFrame([("p", 7, 2, 8)], schema)
    got = sorted(map(tuple, history.combine_histories({"a": ha, "b": hb}, "e").collect()), key=lambda r: r[3])
    assert got == [("p", 1, None, 0, 2), ("p", 1, 7, 2, 6), ("p", 2, 7, 6, 8), ("p", 2, None, 8, None)]
