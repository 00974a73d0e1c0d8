"""One surviving record per group of duplicates, by Bayesian fusion with copy detection.

Every source (a load) claims at most one value per group: that of its preferred row with a known
value. Groups with the same claim pattern (which source says the first, second, ... of the group's
different values) are alike to the model, so all its arithmetic runs on patterns with their counts:

1. patterns are counted; the value with the greatest posterior is held true;
2. each source's accuracy is the mean posterior of its claims;
3. two sources' dependence, in either direction, follows from how often they share a false value, share
   a true one or differ, against what independent sources of their accuracies would do;
4. a claim votes with ln(n A / (1 - A)), discounted by the chance that it was copied from a supporter
   of the same value that votes before it; the posterior is the softmax of vote sums and priors.

Steps 2 to 4 are repeated; the first time all accuracies are held equal. Accuracies, pairs of sources and
patterns are tables from beginning to end: nothing of the model comes to the driver, and its arithmetic is
built-in expressions. Pairs are pairs of sources within a pattern, never of rows.

The order of preference alone settles what `preferred` gives: the survivor and the first row that knows
the value, in one fold without votes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstrata.operators.sizing import lookup_join
from cabstrata.session import materialize

LOW, HIGH, PLAIN, ROUNDS = 0.02, 0.98, 0.8, 4
#: Wrong values that a source could have claimed; share of a copier's claims that are copied; prior chance of a copier.
WRONG, COPIED, COPIER = 20.0, 0.8, 0.1


def preferred(rows: DataFrame, group: str, row_id: str, prefer: list[str], value: str) -> DataFrame:
    """One row per group of two or more: (grp, n_rows, group_row_id, survivor_row_id, value_row_id, value).

    The survivor is the first row in the order of preference: greater is better in each column of prefer
    and null is least; ties go to the smallest row_id. value_row_id is the first row in that order that
    knows the value, or -1 (and the value null) where none does. A null group is a group. Folded on the map
    side, so a group of any size is a row per task.
    """
    order = F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(prefer)], (-F.col(row_id)).alias("id"), F.col(value).alias("v"))
    g = rows.groupBy(F.col(group).alias("grp")).agg(F.count(F.lit(1)).alias("n_rows"), F.min(row_id).alias("first_id"), F.max(order).alias("best"), F.max(F.when(F.col(value).isNotNull(), order)).alias("known")).where("n_rows >= 2")
    return g.select("grp", "n_rows", F.col("first_id").alias("group_row_id"), (-F.col("best.id")).alias("survivor_row_id"), F.coalesce(-F.col("known.id"), F.lit(-1).cast("bigint")).alias("value_row_id"), F.col("known.v").alias("value"))


def survivors(rows: DataFrame, group: str, row_id: str, prefer: list[str], value: str, keep: list[str]) -> DataFrame:
    """One row per group, single rows included: row_id, the columns keep of the first row in the order of
    preference (see preferred), and value, filled from the first row in that order that knows it where the
    survivor doesn't. Every row is sent at most once, none is looked up again, and a group of any size is a row
    per task."""
    rest = [c for c in keep if c not in (*prefer, row_id, value)]
    order = [*[F.col(c).alias(f"p{i}") for i, c in enumerate(prefer)], (-F.col(row_id)).alias("id"), F.col(value).alias("v")]
    whole = F.struct(*order, F.struct(F.lit(0).alias("_"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)]).alias("r"))
    g = rows.groupBy(F.col(group).alias("grp")).agg(F.max(whole).alias("best"), F.max(F.when(F.col(value).isNotNull(), F.struct(*order))).alias("known"))
    held = {c: F.col(f"best.p{i}") for i, c in enumerate(prefer)} | {c: F.col(f"best.r.c{i}") for i, c in enumerate(rest)}
    held |= {row_id: -F.col("best.id"), value: F.coalesce("best.v", "known.v")}
    return g.select(*[held[c].alias(c) for c in dict.fromkeys([row_id, *keep])])


def source_claims(rows: DataFrame, group: str, source: str, row_id: str, prefer: list[str], value: str) -> DataFrame:
    """(grp, src, best, known, first_id, n): a source's preferred row and, where that one's value is null,
    its preferred row with a known value. prefer: columns of which greater is better and null is least;
    ties: the smallest row_id. Folded on the map side, so a group of any size becomes at most one row per
    source. The source itself, if preferred by, is no part of what is sent."""
    own = [c for c in prefer if c != source]
    order = F.struct(*[F.col(c).alias(f"p{prefer.index(c)}") for c in own], (-F.col(row_id)).alias("id"), F.col(value).alias("v"))
    best, known = F.max(order), F.max(F.when(F.col(value).isNotNull(), order))
    folded = rows.groupBy(F.col(group).alias("grp"), F.col(source).alias("src")).agg(best.alias("best"), known.alias("known"), F.min(row_id).alias("first_id"), F.count(F.lit(1)).alias("n"))
    return folded.withColumn("known", F.when(F.col("best.v").isNull(), F.col("known")))


def group_claims(claims: DataFrame, source: str, prefer: list[str]) -> DataFrame:
    """Groups of two or more rows: (grp, n_rows, first_id, best, known, values, pattern). known: the known
    claims in the order of preference; values: their different values in that order; pattern: for each
    source, in order, the number of its value (from 0). Arrays have at most one entry per source."""

    def ranked(c: Column, s: Column) -> Column:
        order = [s.alias(f"p{i}") if name == source else c[f"p{i}"].alias(f"p{i}") for i, name in enumerate(prefer)]
        return F.struct(*order, c["id"].alias("id"), c["v"].alias("v"))

    claim = F.struct("best", "known", "src")
    g = claims.groupBy("grp").agg(F.sum("n").alias("n_rows"), F.min("first_id").alias("first_id"), F.collect_list(claim).alias("c")).where("n_rows >= 2")
    g = g.withColumn("best", F.array_max(F.transform("c", lambda x: ranked(x["best"], x["src"]))))
    told = F.filter(F.transform("c", lambda x: F.struct(ranked(F.coalesce(x["known"], x["best"]), x["src"]).alias("k"), F.coalesce(x["src"], F.lit("")).alias("s"))), lambda x: x["k"]["v"].isNotNull())
    g = g.withColumn("known", F.reverse(F.array_sort(told)))
    g = g.withColumn("values", F.array_distinct(F.transform("known", lambda x: x["k"]["v"])))
    said = F.array_sort(F.transform("known", lambda x: F.struct(x["s"].alias("s"), (F.array_position("values", x["k"]["v"]) - 1).cast("int").alias("v"))))
    return g.select("grp", "n_rows", "first_id", "best", "known", "values", said.alias("pattern"))


def count_patterns(groups: DataFrame) -> DataFrame:
    """(pid, pattern, n): the patterns of groups with a known claim, numbered, with their groups' number."""
    p = groups.where(F.size("pattern") > 0).groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    return materialize(p.select(F.monotonically_increasing_id().alias("pid"), "pattern", "n"), "fusion-patterns")


def source_pairs(patterns: DataFrame) -> DataFrame:
    """(pid, n, s, t, vs, vt), s < t: the pairs of sources that meet in a pattern and what each says."""
    later = F.transform("pattern", lambda x, i: F.transform(F.slice("pattern", i + 2, F.size("pattern")), lambda y: F.struct(x["s"].alias("s"), y["s"].alias("t"), x["v"].alias("vs"), y["v"].alias("vt"))))
    return patterns.where(F.size("pattern") > 1).select("pid", "n", F.explode(F.flatten(later)).alias("p")).select("pid", "n", "p.*")


def agreement(patterns: DataFrame) -> DataFrame:
    """(source_a, source_b, n_groups, n_same): of each pair of sources the groups in which both claim a
    value, and in which it is the same; what the detection of copies rests on."""
    p = source_pairs(patterns)
    return p.groupBy(F.col("s").alias("source_a"), F.col("t").alias("source_b")).agg(F.sum("n").alias("n_groups"), F.sum(F.when(F.col("vs") == F.col("vt"), F.col("n")).otherwise(0)).alias("n_same"))


def copying(a: Column, b: Column, same_true: Column, same_false: Column, differ: Column) -> tuple[Column, Column]:
    """The chances that the first of two sources of accuracies a and b copies the second, and the second
    the first. Who copies shares values as often as they are true at the other one."""
    both = a * b
    wrong = (1 - a) * (1 - b) / WRONG

    def odds(origin: Column) -> Column:
        x = same_true * F.ln((origin * COPIED + both * (1 - COPIED)) / both)
        x = x + same_false * F.ln(((1 - origin) * COPIED + wrong * (1 - COPIED)) / wrong) + differ * F.lit(math.log(1 - COPIED))
        return x + math.log(COPIER / 2 / (1 - COPIER))

    first, second = odds(b), odds(a)
    top = F.greatest(first, second, F.lit(0.0))
    total = F.exp(first - top) + F.exp(second - top) + F.exp(-top)
    return F.exp(first - top) / total, F.exp(second - top) / total


class Model:
    """accuracy: (s, a), a row per source; dependence: (s, t, st, ts), s < t, a row per pair of sources that
    meet: the chances that s copies t and t copies s. The first model has neither: all sources are PLAIN
    and independent."""

    def __init__(self, accuracy: DataFrame | None = None, dependence: DataFrame | None = None):
        self.accuracy, self.dependence = accuracy, dependence

    def _with_accuracy(self, df: DataFrame, source: str, to: str) -> DataFrame:
        if self.accuracy is None:
            return df.withColumn(to, F.lit(PLAIN))
        a = self.accuracy.select(F.col("s").alias(source), F.col("a").alias(to))
        return lookup_join(df, a, [source], salt_on=["pid"], how="left").withColumn(to, F.coalesce(to, F.lit(PLAIN)))

    def scores(self, patterns: DataFrame) -> DataFrame:
        """(pid, votes, posterior): of each value of a pattern the discounted vote sum and the posterior. Of
        sources with the same value the more accurate votes first (ties: the smaller name)."""
        claims = self._with_accuracy(patterns.select("pid", F.explode("pattern").alias("c")).select("pid", "c.*"), "s", "a")
        claims = claims.withColumn("weight", F.ln(F.lit(WRONG) * F.col("a") / (1 - F.col("a"))))
        if self.dependence is not None:
            same = lookup_join(source_pairs(patterns).where("vs = vt"), self.dependence, ["s", "t"], salt_on=["pid"])
            same = self._with_accuracy(self._with_accuracy(same, "s", "as"), "t", "at")
            second = F.when(F.col("at") > F.col("as"), F.col("s")).otherwise(F.col("t"))
            free = same.groupBy("pid", second.alias("s")).agg(F.sum(F.ln(1 - COPIED * (F.col("st") + F.col("ts")))).alias("free"))
            claims = claims.join(free, ["pid", "s"], "left").withColumn("weight", F.col("weight") * F.exp(F.coalesce("free", F.lit(0.0))))
        sums = claims.groupBy("pid", "v").agg(F.sum("weight").alias("w"))
        votes = sums.groupBy("pid").agg(F.array_sort(F.collect_list(F.struct("v", "w"))).alias("x")).select("pid", F.transform("x", lambda e: e["w"]).alias("votes"))
        top = F.greatest(F.array_max("votes"), F.lit(0.0))
        raised = F.transform("votes", lambda w: F.exp(w - top))
        rest = F.greatest(F.lit(0.0), WRONG + 1 - F.size("votes")) * F.exp(-top)
        total = F.aggregate(raised, F.lit(0.0), lambda x, y: x + y) + rest
        return votes.select("pid", "votes", F.transform(raised, lambda e: e / total).alias("posterior"))


def fit(patterns: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model of counted patterns. The first round takes all sources as equally accurate and looks for
    copiers only: else copiers that outvote the others would pass for accurate before they are seen to
    copy. Sharing true values is no evidence in that round, as the accuracies that would explain it aren't
    known yet."""
    model = Model()
    for k in range(rounds):
        scores = materialize(model.scores(patterns), "fusion-scores")
        true = F.array_position("posterior", F.array_max("posterior")) - 1
        judged = scores.select("pid", "posterior", true.cast("int").alias("true"))
        if k:
            claims = patterns.join(judged, "pid").select("n", "posterior", F.explode("pattern").alias("c"))
            mean = F.sum(F.col("n") * F.get("posterior", F.col("c.v"))) / F.sum("n")
            accuracy = materialize(claims.groupBy(F.col("c.s").alias("s")).agg(F.least(F.lit(HIGH), F.greatest(F.lit(LOW), mean)).alias("a")), "fusion-accuracy")
        else:
            accuracy = None
        same, right = F.col("vs") == F.col("vt"), F.col("vs") == F.col("true")
        pairs = source_pairs(patterns).join(judged.select("pid", "true"), "pid")
        counted = pairs.groupBy("s", "t").agg(
            F.sum(F.when(same & right, F.col("n")).otherwise(0)).alias("same_true"), F.sum(F.when(same & ~right, F.col("n")).otherwise(0)).alias("same_false"), F.sum(F.when(~same, F.col("n")).otherwise(0)).alias("differ"), F.min("pid").alias("pid"),
        )
        now = Model(accuracy)
        rated = now._with_accuracy(now._with_accuracy(counted, "s", "as"), "t", "at")
        st, ts = copying(F.col("as"), F.col("at"), F.col("same_true") if k else F.lit(0), F.col("same_false"), F.col("differ"))
        model = Model(accuracy, materialize(rated.select("s", "t", st.alias("st"), ts.alias("ts"), "same_true", "same_false", "differ"), "fusion-dependence"))
    return model


def fuse(rows: DataFrame, group: str, source: str, row_id: str, prefer: list[str], value: str, rounds: int = ROUNDS) -> DataFrame:
    """One row per group of two or more: (grp, n_rows, n_sources, group_row_id, survivor_row_id,
    value_row_id, fused_value, probability).

    The survivor is the first row in the order of preference; the fused value is the one of greatest
    posterior, value_row_id the first row that has it, or -1 where no row knows a value (fused_value and
    probability are then null). A null source is a source of its own; equal posteriors go to the value that
    comes first in the order of preference. Columns of rows that aren't named are never read. An empty
    input gives no rows.
    """
    groups = materialize(group_claims(source_claims(rows, group, source, row_id, prefer, value), source, prefer), "fusion-groups")
    patterns = count_patterns(groups)
    scores = fit(patterns, rounds).scores(patterns).join(patterns.select("pid", "pattern"), "pid").select("pattern", "votes", "posterior")
    place = F.sequence(F.lit(0), F.size("values") - 1)
    ranked = F.transform(place, lambda i: F.struct(F.get("votes", i).alias("w"), (-i).alias("i")))
    top = F.when(F.size("values") > 0, -F.array_max(ranked)["i"])
    joined = lookup_join(groups, materialize(scores, "fusion-posteriors"), ["pattern"], salt_on=["grp"], how="left").withColumn("_top", top).withColumn("fused_value", F.get("values", F.col("_top")))
    # Every source that claims the value has its first such row in known, which is in the order of preference.
    holder = F.get(F.filter("known", lambda x: x["k"]["v"] == F.col("fused_value")), F.lit(0))
    return joined.select(
        "grp", "n_rows", F.size("known").alias("n_sources"), F.col("first_id").alias("group_row_id"), (-F.col("best.id")).alias("survivor_row_id"),
        F.coalesce(-holder["k"]["id"], F.lit(-1).cast("bigint")).alias("value_row_id"), "fused_value", F.get("posterior", F.col("_top")).alias("probability"),
    )
