"""Column profiles by load, from character-class masks and value counts.

A value's mask keeps its punctuation and generalises its characters: digits to 9, capitals to A, small
letters to a. Masks are few, so they are counted where the rows are; a column's dominant masks are its
patterns, rows with other masks its violations, and half the L1 distance between the mask shares of a
load and the one before its drift. A column with a declared domain is judged by its masks first (a value
of another mask is a violation, masks that drift are values that drift) and exactly within them.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabstrata.session import materialize

_FROM = "0123456789" + "abcdefghijklmnopqrstuvwxyz" + "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TO = "9" * 10 + "a" * 26 + "A" * 26


@dataclass(frozen=True)
class Domain:
    """What a column accepts: values of one of these masks, and of those the ones within [low, high] as
    numbers."""

    masks: tuple[str, ...]
    low: float | None = None
    high: float | None = None


def canonical_text(c: Column, dtype: str) -> Column:
    """A number's text without trailing zeros after the point; any other value's text."""
    t = c.cast("string")
    short = F.rtrim(F.rtrim(t, F.lit("0")), F.lit("."))
    if dtype.startswith("decimal"):
        return t if dtype.endswith(",0)") else short
    if dtype in ("double", "float"):
        return F.when(F.contains(t, F.lit("E")) | ~F.contains(t, F.lit(".")), t).otherwise(short)
    return t


def mask(text: Column) -> Column:
    """The character-class mask; letters outside ASCII become a as well."""
    plain = F.translate(text, _FROM, _TO)
    return F.when(F.octet_length(text) == F.length(text), plain).otherwise(F.regexp_replace(plain, r"[^\x00-\x7F]", "a"))


def unpivot_texts(df: DataFrame, load: str, loader: str, columns: list[str]) -> DataFrame:
    """(load, loader, column_name, value): one row per row and column."""
    kinds = dict(df.dtypes)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), canonical_text(F.col(c), kinds[c]).alias("value")) for c in columns])
    return df.select(F.col(load).alias("batch_id"), F.col(loader).alias("loader"), F.explode(pairs).alias("_p")).select("batch_id", "loader", "_p.*")


def load_sequence(counts: DataFrame) -> DataFrame:
    """(batch_id, prev_batch, next_batch): loads of one loader in the order of their ids. One row per
    load, taken from the counts; a null load has no neighbours."""
    loads = counts.where("batch_id is not null").groupBy("batch_id").agg(F.max("loader").alias("loader"))
    w = Window.partitionBy("loader").orderBy("batch_id")
    return loads.select("batch_id", F.lag("batch_id").over(w).alias("prev_batch"), F.lead("batch_id").over(w).alias("next_batch"))


def value_counts(df: DataFrame, load: str, loader: str, columns: list[str]) -> DataFrame:
    """(batch_id, loader, column_name, mask, value, n): the mergeable state of a profile of columns with
    small domains. It is read several times over, so it is written once to the shared folder."""
    g = unpivot_texts(df, load, loader, columns).groupBy("batch_id", "loader", "column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return materialize(g.select("batch_id", "loader", "column_name", mask(F.col("value")).alias("mask"), "value", "n"), "value-counts")


def mask_counts(df: DataFrame, load: str, loader: str, columns: list[str]) -> DataFrame:
    """(batch_id, loader, column_name, mask, n): the mergeable state of a profile of any columns. Masks are
    taken before anything is shuffled."""
    g = unpivot_texts(df, load, loader, columns).withColumn("mask", mask(F.col("value"))).groupBy("batch_id", "loader", "column_name", "mask").agg(F.count(F.lit(1)).alias("n"))
    return materialize(g, "mask-counts")


def column_patterns(counts: DataFrame, rare: float = 0.03) -> DataFrame:
    """(column_name, mask, n_rows, share, place, rare): every mask of every column over all loads, the
    most frequent first (ties: the smallest text). Those with more than `rare` of the column's non-null rows
    are its patterns, the others its rare masks."""
    m = counts.where("mask is not null").groupBy("column_name", "mask").agg(F.sum("n").alias("n_rows"))
    whole, order = Window.partitionBy("column_name"), Window.partitionBy("column_name").orderBy(F.col("n_rows").desc(), "mask")
    total = F.sum("n_rows").over(whole)
    few = F.col("n_rows").cast("decimal(20,0)") <= F.lit(Decimal(str(rare))) * total.cast("decimal(20,0)")
    return m.select("column_name", "mask", "n_rows", (F.col("n_rows") / total).alias("share"), F.row_number().over(order).alias("place"), few.alias("rare"))


def divergence(counts: DataFrame, item: str, seq: DataFrame) -> DataFrame:
    """(batch_id, column_name, <item>_divergence): half the sum over all items of the absolute difference of
    their shares among the non-null rows of a load and of the load before. No join of the two sides:
    each count is sent to its own load as + share and to the next one as - share."""
    known = counts.where(F.col(item).isNotNull()).groupBy("batch_id", "column_name", item).agg(F.sum("n").alias("n"))
    totals = known.groupBy("batch_id", "column_name").agg(F.sum("n").alias("t"))
    shares = known.join(totals, ["batch_id", "column_name"]).join(seq, "batch_id").withColumn("share", F.col("n") / F.col("t"))
    sides = F.array(F.struct(F.when(F.col("prev_batch").isNotNull(), F.col("batch_id")).alias("b"), F.lit(1.0).alias("sign")), F.struct(F.col("next_batch").alias("b"), F.lit(-1.0).alias("sign")))
    signed = shares.select("column_name", item, "share", F.explode(sides).alias("s")).where("s.b is not null")
    diff = signed.groupBy(F.col("s.b").alias("batch_id"), "column_name", item).agg(F.abs(F.sum(F.col("share") * F.col("s.sign"))).alias("d"))
    return diff.groupBy("batch_id", "column_name").agg((F.sum("d") / 2).alias(f"{item}_divergence"))


def profile_from_counts(counts: DataFrame, accepted: dict[str, Domain], rare: float = 0.03) -> DataFrame:
    """Per load and column: rows, nulls, distinct values, rows of rare masks (see column_patterns), rows
    whose mask the column's domain doesn't have, rows of its masks outside its range, and mask and value
    divergence from the load before. Loads without rows don't appear; a column that is null throughout has
    null divergences."""
    known = F.col("value").isNotNull()
    fits, inside = F.lit(True), F.lit(True)
    for c, d in accepted.items():
        number, own = F.col("value").try_cast("double"), F.col("column_name") == c
        fits = F.when(own, F.col("mask").isin(*d.masks)).otherwise(fits)
        within = (number >= d.low if d.low is not None else F.lit(True)) & (number <= d.high if d.high is not None else F.lit(True))
        inside = F.when(own, F.coalesce(within, F.lit(d.low is None and d.high is None))).otherwise(inside)

    def rows(c: Column) -> Column:
        return F.sum(F.when(known & c, F.col("n")).otherwise(0))

    patterns = column_patterns(counts, rare).select("column_name", "mask", "rare")
    seq = load_sequence(counts)
    base = (
        counts.join(patterns, ["column_name", "mask"], "left")
        .groupBy("batch_id", "column_name")
        .agg(
            F.sum("n").alias("n_rows"), F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("n_null"), F.count_distinct("value").alias("n_distinct"),
            rows(F.col("rare")).alias("n_rare_mask"), rows(~fits).alias("n_other_mask"), rows(fits & ~inside).alias("n_outside"),
        )
    )
    prev = base.select(F.col("batch_id").alias("prev_batch"), "column_name", (F.col("n_null") / F.col("n_rows")).alias("prev_null_share"))
    return (
        base.join(seq, "batch_id", "left")
        .join(prev, ["prev_batch", "column_name"], "left")
        .join(divergence(counts, "mask", seq), ["batch_id", "column_name"], "left")
        .join(divergence(counts, "value", seq), ["batch_id", "column_name"], "left")
        .select("batch_id", "column_name", "prev_batch", "n_rows", "n_null", "n_distinct", "n_rare_mask", "n_other_mask", "n_outside", "prev_null_share", "mask_divergence", "value_divergence")
    )


def load_issues(profile: DataFrame, unaccepted: float = 0.03, null_change: float = 0.15, shift: float = 0.2) -> DataFrame:
    """(batch_id, column_name, issue) of a profile: `values`, `nulls`, `shift`. Values are judged by their
    masks, and within the domain's masks by the exact value; a shift is one of masks, which is one of values
    as well, or else one of values within masks."""
    known = F.col("n_rows") - F.col("n_null")
    nulls = F.abs(F.col("n_null") / F.col("n_rows") - F.col("prev_null_share")) > null_change
    bad = F.col("n_other_mask") + F.col("n_outside")
    moved = F.greatest(F.round("mask_divergence", 12), F.round("value_divergence", 12)) > shift
    found = F.array_compact(F.array(
        F.when(bad > known.cast("decimal(20,0)") * F.lit(Decimal(str(unaccepted))), F.lit("values")),
        F.when(nulls, F.lit("nulls")),
        F.when(F.col("prev_batch").isNotNull() & moved, F.lit("shift")),
    ))
    return profile.select("batch_id", "column_name", F.explode(found).alias("issue"))


def mask_profile(counts: DataFrame, rare: float = 0.03) -> DataFrame:
    """From mask_counts, any column, high cardinality included: per load and column the dominant mask
    (ties: the smallest text), the number of masks, the rows of rare masks and the mask divergence from
    the load before."""
    per = counts.groupBy("batch_id", "column_name", "mask").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("batch_id", "column_name").orderBy(F.col("mask").isNull(), F.col("n").desc(), "mask")
    ranked = per.join(column_patterns(counts, rare).select("column_name", "mask", "rare"), ["column_name", "mask"], "left").withColumn("_k", F.row_number().over(w))
    base = ranked.groupBy("batch_id", "column_name").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("mask").isNull(), F.col("n")).otherwise(0)).alias("n_null"), F.count("mask").alias("n_masks"),
        F.max(F.when(F.col("_k") == 1, F.col("mask"))).alias("dominant_mask"), F.sum(F.when(F.col("rare"), F.col("n")).otherwise(0)).alias("n_rare_mask"),
    )
    return base.join(divergence(counts, "mask", load_sequence(counts)), ["batch_id", "column_name"], "left")


def _by_load(df: DataFrame, load: str, columns: list[str], aggs: dict[str, object]) -> DataFrame:
    """(batch_id, n_rows, column_name, <name of each agg>...): one wide row per load, folded where its rows
    are, before it is turned into a row per column."""
    wide = df.groupBy(F.col(load).alias("batch_id")).agg(F.count(F.lit(1)).alias("n_rows"), *[f(c).alias(f"{c}__{k}") for c in columns for k, f in aggs.items()])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{k}").alias(k) for k in aggs]) for c in columns])
    return wide.select("batch_id", "n_rows", F.explode(cells).alias("c")).select("batch_id", "n_rows", "c.*")


def range_profile(df: DataFrame, load: str, columns: list[str]) -> DataFrame:
    """Per load and column: rows, nulls, least and greatest value as text."""
    return _by_load(df, load, columns, {"n_null": lambda c: F.count_if(F.col(c).isNull()), "least": lambda c: F.min(c).cast("string"), "greatest": lambda c: F.max(c).cast("string")})


def distinct_profile(df: DataFrame, load: str, columns: list[str], error: float = 0.02) -> DataFrame:
    """Per load and column: rows and the number of distinct non-null values, estimated with the stated
    relative standard deviation from sketches of a fixed size."""
    return _by_load(df, load, columns, {"approx_distinct": lambda c: F.approx_count_distinct(c, error)})
