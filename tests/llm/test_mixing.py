from itertools import product

import pytest
from pyspark.sql import functions as F

from cabstrata.llm import mixing


def test_flow_is_cheapest():
    arcs = [(0, 2, 2, 1), (0, 3, 2, 0), (2, 4, 2, 0), (3, 4, 2, 2), (2, 3, 1, 0), (4, 1, 3, 0)]
    flow = mixing.min_cost_flow(5, arcs, 0, 1)
    best = None
    for f in product(*[range(c + 1) for _, _, c, _ in arcs]):
        net = [0] * 5
        for x, (a, b, _, _) in zip(f, arcs, strict=True):
            net[a] -= x
            net[b] += x
        if not any(net[2:]):
            value = (-net[1], sum(x * w for x, (*_, w) in zip(f, arcs, strict=True)))
            best = value if best is None or value < best else best
    net = sum(x for x, (_, b, *_) in zip(flow, arcs, strict=True) if b == 1)
    assert (-net, sum(x * w for x, (*_, w) in zip(flow, arcs, strict=True))) == best


def test_route_prefers_texts_not_used_yet():
    held = {("a", "a"): 100, ("a|b", "a"): 100, ("a|b", "b"): 100}
    flow = mixing.route(held, {"a": 100, "a|b": 100}, {"a": (0.5, 2), "b": (0.5, 1), "c": (0.0, 1)}, 200)
    assert flow == {("a", "a"): 100, ("a|b", "b"): 100}
    assert sum(f for (_, s), f in mixing.route(held, {"a": 100, "a|b": 100}, {"a": (0.5, 2), "b": (0.5, 1)}).items() if s == "b") == 100
    assert mixing.route({}, {}, {"a": (1.0, 2)}) == {} and mixing.route({("a", "a"): 5}, {"a": 5}, {"a": (0.5, 1), "b": (0.5, 1)}) == {("a", "a"): 5}


TARGETS = [("x", 0.5, 1), ("y", 0.3, 3), ("z", 0.2, 2)]


def inputs(spark, n=400):
    rows = [(i, ("x", "x", "x", "y")[i % 4] if i % 10 else "z", f"word {i % 97} and more text {i * 7919 % 1000}" if i % 13 else (None, "", "same text in all")[i % 3]) for i in range(n)]
    docs = spark.createDataFrame([*rows, (n, None, "no source"), (n + 1, "other", "no target")], "doc_id bigint, source string, text string").withColumns({"pattern": F.lit(1), "n_tokens": F.lit("clash")})
    return docs, spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")


def test_shares_and_repeats(spark):
    docs, targets = inputs(spark)
    sized = mixing.sized_documents(docs, targets)
    assert sized.count() == 400
    picked = mixing.select_mix(sized, mixing.read_targets(targets))
    most = {s: r for s, _, r in TARGETS}
    got = picked.collect()
    assert len({r.doc_id for r in got}) == len(got) and all(1 <= r.repeats <= most[r.source] and r.n_tokens > 0 for r in got)
    report = {r.source: r for r in mixing.mix_report(picked, sized, targets).collect()}
    assert all(abs(r.off_target) < 0.02 for r in report.values()) and abs(sum(r.share for r in report.values()) - 1) < 1e-9
    # The scarcest source is used up.
    assert any(r.tokens_used >= 0.97 * r.tokens * most[s] for s, r in report.items())
    again = mixing.select_mix(mixing.sized_documents(docs.repartition(7), targets), mixing.read_targets(targets))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))
    assert sorted(map(tuple, mixing.select_mix(sized, mixing.read_targets(targets), seed=7).collect())) != sorted(map(tuple, got))
    small = mixing.select_mix(sized, mixing.read_targets(targets), total=500)
    assert small.agg(F.sum(F.col("n_tokens") * F.col("repeats"))).head()[0] == pytest.approx(500, abs=60)


def test_nothing(spark):
    docs, targets = inputs(spark)
    sized = mixing.sized_documents(docs.limit(0), targets)
    picked = mixing.select_mix(sized, mixing.read_targets(targets))
    assert picked.count() == 0
    assert {r.source: (r.documents, r.share) for r in mixing.mix_report(picked, sized, targets).collect()} == {s: (0, None) for s, _, _ in TARGETS}


def test_many_sources_are_bounded_and_whole(spark, monkeypatch):
    """More sets of sources than are routed: every document can still be selected, shares and caps hold."""
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 3)
    docs, targets = inputs(spark)
    sized = mixing.sized_documents(docs, targets)
    routed = mixing.routed_patterns(sized, 3)
    assert routed.count() == 400 and routed.select("pattern").distinct().count() <= 3 + 3 and sized.select("pattern").distinct().count() > routed.select("pattern").distinct().count()
    report = {r.source: r for r in mixing.mix_report(mixing.select_mix(sized, mixing.read_targets(targets)), sized, targets).collect()}
    assert all(abs(r.off_target) < 0.03 and r.most_repeats <= dict((s, m) for s, _, m in TARGETS)[s] for s, r in report.items())
