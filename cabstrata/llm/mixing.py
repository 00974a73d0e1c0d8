"""Mixing sources to target weights by min-cost flow over membership patterns.

A text may stand in several sources. Texts are aggregated by the set of sources that hold them; the
flow graph has one node per such pattern and one per source, so its size depends on the number of
sources, not of documents:

    start -> pattern    tiers of exposures of the pattern's texts; a further exposure costs more (convex)
    pattern -> source   at most the tokens of the source's documents of that pattern x max_repeats
    source -> end       the source's quota: target share x total

The cheapest flow that fills all quotas says how many tokens of each pattern each source takes. A
document of it is then used tokens // capacity times, and once more if its seeded place in the order of
its pattern and source has its middle within the remainder; places come from sums over hash ranges, so no task
orders a whole source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabstrata.llm.tokens import count_tokens
from cabstrata.operators.sizing import lookup_join
from cabstrata.session import materialize

HASH_RANGES = 4096
#: Sets of sources that are routed as such. Up to nine sources have no more; of further sources' sets those with
#: the most tokens, while texts of all others count for each of their sources by itself.
MAX_PATTERNS = 512


def min_cost_flow(n: int, arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """The flow on each arc (from, to, capacity, cost >= 0) of a cheapest greatest flow, by successive
    shortest paths. Meant for graphs of some hundred nodes."""
    head: list[list[int]] = [[] for _ in range(n)]
    to, cap, cost = [], [], []
    for a, b, c, w in arcs:
        head[a].append(len(to))
        to.append(b), cap.append(c), cost.append(w)
        head[b].append(len(to))
        to.append(a), cap.append(0), cost.append(-w)
    while True:
        best, via = {source: 0}, {}
        queue = [source]
        while queue:
            nxt = []
            for u in queue:
                for e in head[u]:
                    if cap[e] and (to[e] not in best or best[u] + cost[e] < best[to[e]]):
                        best[to[e]], via[to[e]] = best[u] + cost[e], e
                        nxt.append(to[e])
            queue = nxt
        if sink not in best:
            return [cap[2 * i + 1] for i in range(len(arcs))]
        path, v = [], sink
        while v != source:
            path.append(via[v])
            v = to[via[v] ^ 1]
        push = min(cap[e] for e in path)
        for e in path:
            cap[e] -= push
            cap[e ^ 1] += push


def route(held: dict[tuple[str, str], int], distinct: dict[str, int], targets: dict[str, tuple[float, int]], total: int | None = None) -> dict[tuple[str, str], int]:
    """Tokens that each source takes of each pattern.

    held: (pattern, source) -> tokens of the source's documents of that pattern; distinct: pattern ->
    tokens of its different texts; targets: source -> (share, max_repeats). total defaults to the
    greatest for which every source with tokens can fill its quota; a greater one leaves quotas short. A
    source without tokens takes nothing, whatever its share.
    """
    room = {s: sum(t * targets[s][1] for (_, q), t in held.items() if q == s) for s in targets}
    live = [s for s in sorted(targets) if room[s] > 0 and targets[s][0] > 0]
    if not live:
        return {}
    whole = min(int(room[s] / targets[s][0]) for s in live) if total is None else total
    patterns = sorted({p for p, s in held if s in live})
    node = {("p", p): i + 2 for i, p in enumerate(patterns)} | {("s", s): i + 2 + len(patterns) for i, s in enumerate(live)}
    arcs, taken = [], {}
    for p in patterns:
        use = sum(t * targets[s][1] for (q, s), t in held.items() if q == p and s in live)
        at, width = 0, 1  # exposures 1, 2, 3-4, 5-8, ...: each tier costs as many as were before it
        while use > 0:
            step = min(use, max(1, distinct[p]) * width)
            arcs.append((0, node["p", p], step, at))
            use, at, width = use - step, at + width, max(1, at + width)
        for s in live:
            if (p, s) in held:
                taken[p, s] = len(arcs)
                arcs.append((node["p", p], node["s", s], held[p, s] * targets[s][1], 0))
    arcs += [(node["s", s], 1, min(room[s], int(whole * targets[s][0])), 0) for s in live]
    flow = min_cost_flow(len(node) + 2, arcs, 0, 1)
    return {k: flow[i] for k, i in taken.items() if flow[i]}


def sized_documents(documents: DataFrame, targets: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, source, pattern, text_key, n_tokens) of the documents of the target sources, written
    once to the shared folder. Null sources have no target and are no part of the mix."""
    known = documents.where(F.col("source").isin(list(read_targets(targets))))
    keyed = known.select("doc_id", "source", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_key"), "text")
    sizes = materialize(count_tokens(keyed, ["doc_id", "source", "text_key"], "text", path), "mix-sizes")
    shared = sizes.groupBy("text_key").agg(F.array_join(F.array_sort(F.collect_set("source")), "|").alias("pattern"), F.count_distinct("source").alias("k")).where("k > 1").select("text_key", "pattern")
    joined = lookup_join(sizes, materialize(shared, "mix-shared"), ["text_key"], salt_on=["doc_id"], how="left")
    return materialize(joined.withColumn("pattern", F.coalesce("pattern", "source")), "mix-documents")


def routed_patterns(sized: DataFrame, sources: int) -> DataFrame:
    """The documents with at most MAX_PATTERNS + sources patterns. Every document stays and can be selected;
    a text whose set of sources isn't among those kept is only no longer known to be in several sources,
    which bears on the cost of its exposures."""
    if 2**sources - 1 <= MAX_PATTERNS:
        return sized
    most = sized.groupBy("pattern").agg(F.sum("n_tokens").alias("t")).orderBy(F.col("t").desc(), "pattern").limit(MAX_PATTERNS).select("pattern", F.lit(True).alias("_kept"))
    return sized.join(F.broadcast(most), "pattern", "left").withColumn("pattern", F.when(F.col("_kept"), F.col("pattern")).otherwise(F.col("source"))).drop("_kept")


def select_mix(sized: DataFrame, targets: dict[str, tuple[float, int]], seed: int = 42, total: int | None = None) -> DataFrame:
    """(doc_id, source, n_tokens, repeats) of the documents used at least once. repeats never exceeds the
    source's max_repeats; a source misses its quota by at most half a document per pattern. The same
    seed and data give the same selection, however they are partitioned. Documents without tokens fill
    no quota and aren't selected."""
    sized = routed_patterns(sized, len(targets))
    sums = sized.groupBy("pattern", "source").agg(F.sum("n_tokens").alias("t")).collect()  # at most MAX_PATTERNS x sources
    distinct = sized.groupBy("pattern", "text_key").agg(F.max("n_tokens").alias("t")).groupBy("pattern").agg(F.sum("t").alias("t")).collect()
    held = {(r.pattern, r.source): r.t for r in sums if r.t}
    flow = route(held, {r.pattern: r.t for r in distinct}, targets, total)
    spark = sized.sparkSession
    plan = spark.createDataFrame([(p, s, f // held[p, s], f % held[p, s]) for (p, s), f in flow.items()], "pattern string, source string, full bigint, rest bigint")
    by = ["pattern", "source"]
    h = F.xxhash64(F.lit(seed), "doc_id")
    docs = sized.where("n_tokens > 0").join(F.broadcast(plan), by).withColumns({"_h": h, "_range": F.pmod(F.shiftrightunsigned(h, 40), F.lit(HASH_RANGES))})
    sums = docs.groupBy(*by, "_range").agg(F.sum("n_tokens").alias("_t"))
    before = sums.withColumn("_before", F.sum("_t").over(Window.partitionBy(*by).orderBy("_range")) - F.col("_t")).drop("_t")
    inside = F.sum("n_tokens").over(Window.partitionBy(*by, "_range").orderBy("_h", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    placed = lookup_join(docs, materialize(before, "mix-offsets"), [*by, "_range"], salt_on=["doc_id"]).withColumn("_cum", inside + F.col("_before"))
    repeats = F.col("full") + F.when((F.col("rest") > 0) & (F.col("_cum") - F.col("n_tokens") / 2 <= F.col("rest")), 1).otherwise(0)
    return placed.select("doc_id", "source", "n_tokens", repeats.cast("int").alias("repeats")).where("repeats > 0")


def read_targets(targets: DataFrame) -> dict[str, tuple[float, int]]:
    """The table of targets, one row per source; it is a setting, not data."""
    return {r.source: (float(r.target_share or 0), int(r.max_repeats or 0)) for r in targets.collect() if r.source is not None}


def mix_report(selection: DataFrame, sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source of the targets: documents and tokens there, documents used, tokens reached with
    repeats, the most one document is used, the share reached and its distance from the target. A source
    without tokens can reach nothing; reachable_share is the target among the sources that have some."""
    there = sized.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("tokens"))
    used = selection.groupBy("source").agg(F.count(F.lit(1)).alias("documents_used"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens_used"), F.max("repeats").alias("most_repeats"))
    j = targets.join(there, "source", "left").join(used, "source", "left").na.fill(0, ["documents", "tokens", "documents_used", "tokens_used", "most_repeats"])
    whole = Window.partitionBy(F.lit(1))
    share = F.col("tokens_used") / F.nullif(F.sum("tokens_used").over(whole), F.lit(0))
    able = F.when((F.col("tokens") > 0) & (F.col("max_repeats") > 0), F.col("target_share"))
    return j.withColumns({"share": share, "reachable_share": able / F.sum(able).over(whole)}).withColumn("off_target", F.col("share") - F.col("target_share"))
