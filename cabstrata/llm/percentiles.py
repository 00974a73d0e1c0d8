"""Percentiles per group from cumulative frequencies.

The state is a frequency table: one row per group and value with its count. States of loads or days
add up, so results of any partition can be stored and put together later. The selection splits the values
of every large group into ranges, sums counts inside each range by a window, adds the ranges before it
as an offset, and picks the first value that reaches each target rank.

How many ranges a group has follows from its number of different values, and its cut points are its own:
no task sorts more than about RANGE_ROWS values of a group, however narrow its values and however large
the group. The state is shuffled once, to the windows; offsets are looked up.

Error: with resolution None none at all (nearest rank, lower). With a resolution r values are first
rounded to the middle of their cell of width r, so every result is within r / 2 of the exact one.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cabstrata.operators.sizing import lookup_join
from cabstrata.session import materialize

#: Different values of a group up to which it is one range.
RANGE_ROWS = 200_000


def frequency_state(df: DataFrame, groups: list[str], value: str, resolution: float | None = None) -> DataFrame:
    """(groups, value, n). Null and NaN values are rows without a value: they are counted under a null
    value and take no rank."""
    v = F.col(value)
    kind = dict(df.dtypes)[value]
    if kind in ("double", "float"):
        v = F.when(~F.isnan(v), v)
    if resolution:
        v = F.floor(v / F.lit(resolution)) * F.lit(resolution) + F.lit(resolution / 2)
    return df.groupBy(*groups, v.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def merge_states(states: DataFrame, groups: list[str]) -> DataFrame:
    """States of parts, one under the other, as one state of the given (coarser) groups."""
    return states.groupBy(*groups, "value").agg(F.sum("n").alias("n"))


def store_state(state: DataFrame, path: str, part: str) -> DataFrame:
    """Writes a state under path, a directory for each value of the column `part` (a day or load). Parts that
    are there already are replaced, all others stay. Returns all that is stored."""
    even = state.hint("rebalance", part)
    even.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(part).parquet(path)
    return stored_state(state.sparkSession, path, state.schema)


def stored_state(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All parts stored under path; choose some by a filter on the part's column."""
    return spark.read.schema(schema).parquet(path)


def _log2(n: int) -> int:
    return max(0, n - 1).bit_length()


def _cuts(keyed: DataFrame, sizes: DataFrame, range_rows: int) -> DataFrame | None:
    """(_key, _cuts) of the groups that need more than one range: values that split the group's state evenly,
    the next power of two of its size by range_rows in number. None if there is no such group. What
    comes to the driver are the different powers of two."""
    large = sizes.where(F.col("_rows") > range_rows).select("_key", F.ceil(F.log2(F.col("_rows") / range_rows)).cast("int").alias("_class"))
    large = materialize(large, "large-groups")
    classes = sorted(r[0] for r in large.select("_class").distinct().collect())
    if not classes:
        return None
    rows = lookup_join(keyed, large, ["_key"], salt_on=["value"])
    parts = []
    for c in classes:
        at = [i / 2**c for i in range(1, 2**c)]
        parts.append(rows.where(F.col("_class") == c).groupBy("_key").agg(F.percentile_approx("value", at, max(10_000, 20 * 2**c)).alias("_cuts")))
    return materialize(reduce(lambda a, b: a.unionByName(b), parts), "cuts")


def range_number(value: Column, cuts: Column, most: int) -> Column:
    """How many of the sorted cuts (at most `most`) are at or below the value, by halving steps."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(_log2(most + 1)))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) <= value, at + step).otherwise(at))


def percentiles(state: DataFrame, groups: list[str], quantiles: dict[str, str], resolution: float | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(groups, n_values, n_null, <name> of each quantile, error_bound); quantiles: name -> decimal text.

    The result of q among n values is the value at rank max(1, ceil(q * n)). A group without values
    has null percentiles; a null group is a group; an empty state gives no rows. The state is read for
    the sizes, the cuts and the ranks, so it is written once to the shared folder.
    """
    state = materialize(state.select(F.struct(*groups).alias("_key"), "value", "n"), "frequencies")
    known, has = state.where("value is not null"), F.col("value").isNotNull()
    sizes = state.groupBy("_key").agg(F.sum(F.when(has, F.col("n")).otherwise(0)).alias("n_values"), F.sum(F.when(has, 0).otherwise(F.col("n"))).alias("n_null"), F.count("value").alias("_rows"))
    sizes = materialize(sizes, "sizes")
    cuts = _cuts(known, sizes, range_rows)
    if cuts is None:
        placed = known.withColumn("_range", F.lit(0))
        offsets = sizes.select("_key", F.lit(0).alias("_range"), F.lit(0).cast("bigint").alias("_offset"), F.col("n_values").alias("_all"))
    else:
        most = cuts.agg(F.max(F.size("_cuts"))).first()[0]
        placed = lookup_join(known, cuts, ["_key"], salt_on=["value"], how="left")
        placed = placed.withColumn("_range", F.when(F.col("_cuts").isNull(), 0).otherwise(range_number(F.col("value"), F.col("_cuts"), most))).drop("_cuts")
        order = Window.partitionBy("_key").orderBy("_range")
        totals = placed.groupBy("_key", "_range").agg(F.sum("n").alias("_t"))
        before = F.sum("_t").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_t")
        offsets = materialize(totals.select("_key", "_range", before.alias("_offset"), F.sum("_t").over(Window.partitionBy("_key")).alias("_all")), "offsets")
    running = placed.withColumn("_run", F.sum("n").over(Window.partitionBy("_key", "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)))
    ranked = lookup_join(running, offsets, ["_key", "_range"], salt_on=["value"]).withColumn("_cum", F.col("_offset") + F.col("_run"))

    def reach(q: str) -> Column:
        rank = F.greatest(F.ceil(F.lit(Decimal(q)) * F.col("_all").cast("decimal(20,0)")), F.lit(1))
        return F.min(F.when(F.col("_cum") >= rank, F.col("value")))

    picked = ranked.groupBy("_key").agg(*[reach(q).alias(name) for name, q in quantiles.items()])
    return sizes.join(picked, "_key", "left").select("_key.*", "n_values", "n_null", *quantiles, F.lit((resolution or 0.0) / 2).alias("error_bound"))
