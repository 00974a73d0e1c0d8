"""Slowly changing history (type 2) by comparing the current version with a new state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def scd2_start(source: DataFrame, at: str) -> DataFrame:
    """All rows of the source as open versions from `at` (a timestamp text)."""
    t = F.lit(at).cast("timestamp_ntz")
    return source.withColumns({"valid_from": t, "valid_to": F.lit(None).cast("timestamp_ntz")})


def scd2_apply(target: DataFrame, source: DataFrame, key: str, check: list[str], at: str) -> DataFrame:
    """The target after one run. A key whose checked columns differ (null equals null) is closed at `at`
    and opened again with the source's row; a new key is opened; a key missing from the source and an
    equal one stay as they are, so a second run with the same source changes nothing. The source has
    one row per key; keys aren't null."""
    t = F.lit(at).cast("timestamp_ntz")
    digest = F.struct(*check)
    new = source.select(F.col(key).alias("_k"), digest.alias("_new"))
    old = target.where("valid_to is null").select(F.col(key).alias("_k"), digest.alias("_old"))
    marked = target.join(new, F.col(key) == F.col("_k"), "left").drop("_k")
    changed = F.col("valid_to").isNull() & F.col("_new").isNotNull() & ~digest.eqNullSafe(F.col("_new"))
    kept = marked.withColumn("valid_to", F.when(changed, t).otherwise(F.col("valid_to"))).drop("_new")
    fresh = source.join(old, F.col(key) == F.col("_k"), "left").where(F.col("_old").isNull() | ~digest.eqNullSafe(F.col("_old"))).drop("_k", "_old")
    return kept.unionByName(scd2_start(fresh, at).select(*kept.columns))


def scd2_overlaps(history: DataFrame, key: str) -> DataFrame:
    """Versions that begin before the one before them ends: there should be none."""
    before = F.lag("valid_to").over(Window.partitionBy(key).orderBy("valid_from"))
    first = F.row_number().over(Window.partitionBy(key).orderBy("valid_from")) == 1
    return history.withColumn("_bad", ~first & (before.isNull() | (before > F.col("valid_from")))).where("_bad").drop("_bad")
