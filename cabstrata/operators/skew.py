"""Per-key results by eager aggregation through joins.

Both inputs are reduced to one compact state per join key (and roll-up column) before they meet, so
that the join and the roll-up see keys instead of rows. A join of n left with m right rows of a key
has n*m rows; every left sum stands in it m times and every right sum n times. A key's share of the
rows therefore decides only how much a task folds into its own hash map, never which task gets it.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstrata.session import materialize


def compact(df: DataFrame, by: list[str], sums: dict[str, Column] | None = None, count: str = "_n") -> DataFrame:
    """One row per group: its number of rows and sums; partial on the map side."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(count), *[F.sum(c).alias(k) for k, c in (sums or {}).items()])


def eager_join_aggregate(
    left: DataFrame,
    right: DataFrame,
    key: list[str],
    rollup: list[str],
    left_by: list[str] | None = None,
    right_by: list[str] | None = None,
    left_sums: dict[str, Column] | None = None,
    right_sums: dict[str, Column] | None = None,
    how: str = "inner",
    count: str = "joined_rows",
) -> DataFrame:
    """SELECT rollup, count(*), sum(...) FROM left JOIN right USING (key) GROUP BY rollup, without
    forming the joined rows.

    left and right need the columns of key; left_by and right_by are further columns of that side
    that rollup uses. how is inner or left; a left row without partner counts once and brings null
    right sums. Null keys match nothing: they vanish from an inner join and stay, alone, in a left
    one. Empty inputs give no rows. Other columns of the inputs are never read, so clashing names do
    no harm. A sum over nulls only is null.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how: {how}")
    ls, rs = left_sums or {}, right_sums or {}
    a = compact(left, [*key, *(left_by or [])], ls, "_nl")
    b = compact(right, [*key, *(right_by or [])], rs, "_nr")
    j = a.join(b, key, how)
    times = F.coalesce(F.col("_nr"), F.lit(1).cast("bigint"))
    return j.groupBy(*rollup).agg(
        F.sum(F.col("_nl") * times).alias(count),
        *[F.sum(F.col(c) * times).alias(c) for c in ls],
        *[F.sum(F.col(c) * F.col("_nl")).alias(c) for c in rs],
    )


def heavy_keys(states: DataFrame, key: str, weight: str, share: float) -> DataFrame:
    """The keys with more than `share` of all weight, from states of one row per key. A null key counts in
    the total and isn't a key. The states are needed for the total and again for the keys: they are written
    once, so that what they were made of is read once."""
    states = materialize(states.select(key, weight), "key-states")
    total = states.select(F.sum(weight).alias("t")).scalar()
    return states.where(F.col(key).isNotNull() & (F.col(weight) > total.cast("decimal(20,0)") * F.lit(Decimal(str(share))))).select(key)
