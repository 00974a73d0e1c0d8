"""Upserts and replacements as set algebra, for tables without MERGE."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstrata.functions.keys import bare_name


def _unmatched(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    s = source.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)]).distinct()
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_s{i}"))
    return target.join(s, on, "left_anti")


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target after MERGE on keys: source rows replace those of their key, others are added. The
    source has one row per key. Columns that only one side has are null for the other's rows."""
    return _unmatched(target, source, keys).unionByName(source, allowMissingColumns=True)


def delete_insert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target without any row of a key that the source has, and the source's rows, any number per
    key. Keys that vanished from the source stay; replace_scope removes them."""
    return _unmatched(target, source, keys).unionByName(source, allowMissingColumns=True)


def replace_scope(target: DataFrame, source: DataFrame, scope: str) -> DataFrame:
    """The target with everything in the scope (a SQL predicate) replaced by the source's rows in it."""
    return target.where(f"not coalesce({scope}, false)").unionByName(source.where(scope), allowMissingColumns=True)


def synced(target: DataFrame, columns: list[str]) -> DataFrame:
    """The target with exactly these columns: missing ones null, others dropped."""
    have = set(target.columns)
    return target.select(*[F.col(c) if c in have else F.lit(None).alias(c) for c in columns])


def delete_by_file(table: DataFrame, filename: str, column: str) -> DataFrame:
    """The table without the rows of one file, whatever directory, case or blanks its name was written with."""
    return table.where(~F.coalesce(bare_name(F.col(column)) == bare_name(F.lit(filename)), F.lit(False)))
