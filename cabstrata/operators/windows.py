"""Filters on window results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def qualify(df: DataFrame, predicate: Column) -> DataFrame:
    """The rows for which a predicate over window functions holds; a null predicate drops the row."""
    return df.withColumn("_qualify", predicate).where("_qualify").drop("_qualify")


def first_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per group: the first in `order`. Planned with a group limit before the shuffle, so a hot
    group sends one row per task."""
    return qualify(df, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1)


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The rows of the first k ranks of each group, ties included, with their rank."""
    return df.withColumn(rank, F.rank().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")).where(F.col(rank) <= k)


def shifted(df: DataFrame, keys: list[str], order: list[str], column: str, name: str) -> DataFrame:
    """The column's value in the group's row before."""
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return df.withColumn(name, F.lag(column).over(w.orderBy(*order)))
