"""Unions in which one source has priority for a key both hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstrata.operators.windows import first_per_group


def union_all(frames: list[DataFrame]) -> DataFrame:
    """By name; columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def priority_union(sources: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """All rows of the sources, tagged by `source`; of a key that several hold only the row of the first
    named one stays. Each source has one row per key."""
    tagged = union_all([df.select(F.lit(name).alias("source"), F.lit(i).alias("_priority"), "*") for i, (name, df) in enumerate(sources.items())])
    return first_per_group(tagged, keys, [F.col("_priority")]).drop("_priority")
