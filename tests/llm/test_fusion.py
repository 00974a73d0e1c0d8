import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cabstrata.llm import fusion

SCHEMA = "id bigint, grp string, load string, at int, filled int, fare int"


def clashing(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({"src": F.lit("clash"), "known": F.lit(1), "n": F.lit(2)})


def run(spark, rows):
    return {r.grp: r for r in fusion.fuse(clashing(spark, rows), "grp", "load", "id", ["at", "load", "filled"], "fare").collect()}


def patterns(spark, rows):
    claims = fusion.source_claims(spark.createDataFrame(rows, SCHEMA), "grp", "load", "id", ["at", "load"], "fare")
    return fusion.count_patterns(fusion.group_claims(claims, "load", ["at", "load"]))


def brute(rows):
    out = {}
    for g in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == g]
        if len(own) > 1:
            none_last = lambda x: (x is not None, x if x is not None else 0)
            own.sort(key=lambda r: (none_last(r[3]), (r[2] is not None, r[2] or ""), none_last(r[4]), -r[0]), reverse=True)
            known = [r for r in own if r[5] is not None]
            out[g] = (min(r[0] for r in own), own[0][0], known[0][0] if known else -1, known[0][5] if known else None, len(own))
    return out


row = st.tuples(st.sampled_from("pqr"), st.sampled_from(["b1", "b2", "b3", None]), st.one_of(st.none(), st.integers(0, 2)), st.integers(0, 2), st.one_of(st.none(), st.integers(0, 2)))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=14))
def test_preferred_rows(spark, rows):
    rows = [(i, *r) for i, r in enumerate(rows)]
    got = fusion.preferred(clashing(spark, rows), "grp", "id", ["at", "load", "filled"], "fare").collect()
    assert {r.grp: (r.group_row_id, r.survivor_row_id, r.value_row_id, r.value, r.n_rows) for r in got} == brute(rows)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=14))
def test_survivors(spark, rows):
    rows = [(i, *r) for i, r in enumerate(rows)]
    got = fusion.survivors(clashing(spark, rows), "grp", "id", ["at", "load", "filled"], "fare", ["grp", "load", "fare", "src"]).collect()
    want = brute(rows) | {r[1]: (r[0], r[0], 0, r[5], 1) for r in rows if sum(x[1] == r[1] for x in rows) == 1}
    of = {r[0]: r for r in rows}
    assert {r.grp: (r.id, r.load, r.fare, r.src) for r in got} == {g: (w[1], of[w[1]][2], of[w[1]][5] if of[w[1]][5] is not None else w[3], "clash") for g, w in want.items()} and len(got) == len(want)


def modelled(rows, rounds=fusion.ROUNDS):
    """The model once more, in plain Python over single groups: (accuracy, dependence, posteriors)."""
    best = {}
    for i, g, s, at, _, v in rows:
        if v is not None:
            best[g, s] = max(best.get((g, s), (-1, 0, 0)), (at, -i, v))
    groups = {}
    for (g, s), (at, i, v) in best.items():
        groups.setdefault(g, []).append((at, s, i, v))
    claims = {}
    for g, own in groups.items():
        values = list(dict.fromkeys(v for *_, v in sorted(own, reverse=True)))
        claims[g] = (values, {s: values.index(v) for _, s, _, v in own})
    sizes = {g: sum(r[1] == g for r in rows) for g in claims}
    claims = {g: c for g, c in claims.items() if sizes[g] > 1}
    acc, dep = {}, {}

    def posterior(said, k):
        votes = [0.0] * k
        done = []
        for s in sorted(said, key=lambda s: (-acc.get(s, fusion.PLAIN), s)):
            a, free = acc.get(s, fusion.PLAIN), 1.0
            for t in done:
                if said[t] == said[s]:
                    free *= 1 - fusion.COPIED * sum(dep.get((min(s, t), max(s, t)), (0, 0)))
            votes[said[s]] += math.log(fusion.WRONG * a / (1 - a)) * free
            done.append(s)
        e = [math.exp(v) for v in votes]
        return [x / (sum(e) + max(0.0, fusion.WRONG + 1 - k)) for x in e]

    for r in range(rounds):
        posts = {g: posterior(said, len(values)) for g, (values, said) in claims.items()}
        if r:
            per = {}
            for g, (_, said) in claims.items():
                for s, v in said.items():
                    per.setdefault(s, []).append(posts[g][v])
            new_acc = {s: min(fusion.HIGH, max(fusion.LOW, sum(x) / len(x))) for s, x in per.items()}
        else:
            new_acc = {}
        seen = {}
        for g, (_, said) in claims.items():
            true = max(range(len(posts[g])), key=lambda v: (posts[g][v], -v))
            for s in said:
                for t in said:
                    if s < t:
                        x = seen.setdefault((s, t), [0, 0, 0])
                        x[2 if said[s] != said[t] else 0 if said[s] == true else 1] += 1
        acc, dep = new_acc, {}
        for (s, t), (nt, nf, nd) in seen.items():
            a, b = acc.get(s, fusion.PLAIN), acc.get(t, fusion.PLAIN)
            wrong, c = (1 - a) * (1 - b) / fusion.WRONG, fusion.COPIED
            o = [math.log(fusion.COPIER / 2 / (1 - fusion.COPIER)) + (nt if r else 0) * math.log((x * c + a * b * (1 - c)) / (a * b)) + nf * math.log(((1 - x) * c + wrong * (1 - c)) / wrong) + nd * math.log(1 - c) for x in (b, a)]
            top = max(*o, 0.0)
            total = sum(math.exp(x - top) for x in [*o, 0.0])
            dep[s, t] = tuple(math.exp(x - top) / total for x in o)
    return acc, dep, {g: (values, posterior(said, len(values))) for g, (values, said) in claims.items()}


def test_equals_the_model_over_single_groups(spark):
    rnd = random.Random(4)
    rows = [(i, f"g{rnd.randrange(60)}", rnd.choice(["b1", "b2", "b3", "b|=4", "b5"]), rnd.randrange(3), 1, rnd.choice([None, 1, 2, 2, 3])) for i in range(400)]
    acc, dep, posts = modelled(rows)
    m = fusion.fit(patterns(spark, rows))
    assert {r.s: pytest.approx(r.a) for r in m.accuracy.collect()} == acc
    got = {(r.s, r.t): (r.st, r.ts) for r in m.dependence.collect()}
    assert got.keys() == dep.keys() and all(got[k] == pytest.approx(dep[k], abs=1e-9) for k in dep)
    fused = {r.grp: r for r in fusion.fuse(spark.createDataFrame(rows, SCHEMA), "grp", "load", "id", ["at", "load"], "fare").collect()}
    for g, (values, p) in posts.items():
        assert fused[g].fused_value == values[max(range(len(p)), key=lambda v: (round(p[v], 12), -v))] and fused[g].probability == pytest.approx(max(p))


def world(groups=600, seed=1):
    """Five loads that are right nine times in ten, one that is right six times, and two that copy it,
    mistakes included. The method needs the honest ones to prevail at first."""
    rnd, rows, truth, i = random.Random(seed), [], {}, 0
    for g in range(groups):
        truth[f"g{g}"] = t = rnd.randrange(100)
        bad = t if rnd.random() < 0.6 else 100 + rnd.randrange(20)
        for s in ("a1", "a2", "a3", "a4", "a5", "z1", "z2", "z3"):
            v = bad if s[0] == "z" else t if rnd.random() < 0.9 else 100 + rnd.randrange(20)
            if s[0] == "z" or rnd.random() < 0.8:
                rows.append((i := i + 1, f"g{g}", s, 1, 1, v))
    return rows, truth


def test_copies_are_discounted(spark):
    rows, truth = world()
    got = run(spark, rows)
    share = sum(r.fused_value == truth[g] for g, r in got.items()) / len(got)
    votes = {}
    for _, g, _, _, _, v in rows:
        votes.setdefault(g, []).append(v)
    majority = sum(max(set(v), key=lambda x: (v.count(x), x)) == truth[g] for g, v in votes.items() if len(v) > 1) / len(got)
    assert share > majority + 0.08 and share > 0.95
    m = fusion.fit(patterns(spark, rows))
    dep = {(r.s, r.t): r.st + r.ts for r in m.dependence.collect()}
    acc = {r.s: r.a for r in m.accuracy.collect()}
    assert dep["z1", "z2"] > 0.99 and dep["z2", "z3"] > 0.99 and max(v for (a, b), v in dep.items() if "z" not in a[0] + b[0]) < 0.5
    assert min(acc[f"a{k}"] for k in "12345") > acc["z1"]


def test_direction_and_counts(spark):
    """A careful source that copies a careless one is the likelier copier; agreement counts groups."""
    rnd, rows, i = random.Random(3), [], 0
    for g in range(800):
        t = rnd.randrange(50)
        err = lambda: 100 + rnd.randrange(20)
        said = {f"a{k}": t if rnd.random() < 0.9 else err() for k in range(4)} | {"low": t if rnd.random() < 0.6 else err()}
        if g % 4 == 0:
            said["copier"] = said["low"]
        elif g % 4 < 3:
            said["copier"] = t if rnd.random() < 0.95 else err()
        rows += [(i := i + 1, f"g{g}", s, 1, 1, v) for s, v in said.items()]
    p = patterns(spark, rows)
    met = {(r.source_a, r.source_b): (r.n_groups, r.n_same) for r in fusion.agreement(p).collect()}
    said = {}
    for _, g, s, _, _, v in rows:
        said.setdefault(s, {})[g] = v
    for (a, b), (n, same) in met.items():
        both = said[a].keys() & said[b].keys()
        assert (n, same) == (len(both), sum(said[a][g] == said[b][g] for g in both))
    st, ts = fusion.copying(F.lit(0.9), F.lit(0.6), F.lit(60), F.lit(40), F.lit(5))
    a, b = spark.range(1).select(st, ts).head()
    assert a > b and a + b > 0.99  # the shared values are as often false as those of the careless one
    model = {(r.s, r.t): (r.st, r.ts) for r in fusion.fit(p).dependence.collect()}
    assert max(sum(v) for k, v in model.items() if k[0][0] == k[1][0] == "a") < 0.5


def planted(spark, small, copied):
    """The real loads of the smallest table, with loads added that repeat `copied` of one load's claims,
    mistakes planted in a third of them, and one that only tells the truth."""
    from cabstrata.functions.keys import trip_key
    from cabstrata.session import load

    real = load(spark, small, "yellow_tripdata").select(F.col("_row_id").alias("id"), trip_key().alias("grp"), F.col("_ingest_batch_id").alias("load"), F.lit(1).alias("at"), F.lit(1).alias("filled"), (F.col("fare_amount") * 100).cast("int").alias("fare"))
    base = real.where("fare is not null and load is not null").dropDuplicates(["grp"])
    h = lambda n: F.pmod(F.xxhash64("grp", F.lit(n)), F.lit(100))
    wrong = F.when(h(1) < 33, F.col("fare") + 1 + h(2)).otherwise(F.col("fare"))
    origin = base.select((F.col("id") + 10**9).alias("id"), "grp", F.lit("origin").alias("load"), "at", "filled", wrong.cast("int").alias("fare"))
    copies = [origin.where(h(10 + k) < copied).withColumns({"id": F.col("id") + (k + 1) * 10**9, "load": F.lit(f"copier{k}")}) for k in range(3)]
    honest = [base.select((F.col("id") + (10 + k) * 10**9).alias("id"), "grp", F.lit(f"honest{k}").alias("load"), "at", "filled", F.when(h(20 + k) < 5, F.col("fare") + 200 + h(30 + k)).otherwise(F.col("fare")).cast("int").alias("fare")) for k in range(4)]
    for x in [origin, *copies, *honest]:
        real = real.unionByName(x)
    return real


def test_planted_copiers_are_found_in_the_trips(spark, small):
    claims = fusion.source_claims(planted(spark, small, 80), "grp", "load", "id", ["at", "load"], "fare")
    m = fusion.fit(fusion.count_patterns(fusion.group_claims(claims, "load", ["at", "load"])))
    ring = {"origin", "copier0", "copier1", "copier2"}
    dep = {frozenset((r.s, r.t)): r.st + r.ts for r in m.dependence.collect()}
    inside = [v for k, v in dep.items() if k <= ring]
    honest = [v for k, v in dep.items() if all(x.startswith("honest") for x in k)]
    assert len(inside) == 6 and min(inside) > 0.99 and len(honest) == 6 and max(honest) < 0.5
    assert max(v for k, v in dep.items() if len(k & ring) == 1 and any(x.startswith("honest") for x in k)) < 0.5


def test_nothing_and_no_known_value(spark):
    assert run(spark, []) == {} and run(spark, [(1, "p", "b1", 1, 1, 5)]) == {}
    r = run(spark, [(1, "p", "b1", 1, 1, None), (2, "p", "b2", 2, 1, None), (3, "p", "b2", 2, 1, None)])["p"]
    assert (r.survivor_row_id, r.value_row_id, r.fused_value, r.probability, r.n_sources) == (2, -1, None, None, 0)
    assert fusion.preferred(clashing(spark, []), "grp", "id", ["at"], "fare").count() == 0
