"""Ordered first-match classification of rows; invalid ones are set aside, never dropped."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A reason and the SQL predicate that gives it. An unknown predicate doesn't match."""

    reason: str
    when: str


# Reasons in their order, with their limits.
TRIP_RULES = [
    Rule("null_timestamp", "pickup_ts is null or dropoff_ts is null"),
    Rule("pickup_ge_dropoff", "pickup_ts >= dropoff_ts"),
    Rule("duration_out_of_range", "trip_duration_min > 720"),
    Rule("non_positive_distance", "trip_distance is null or trip_distance <= 0"),
    Rule("distance_out_of_range", "trip_distance > 200"),
    Rule("negative_fare_or_total", "fare_amount < 0 or total_amount < 0"),
    Rule("excessive_fare_or_total", "fare_amount > 1000 or total_amount > 1000"),
    Rule("tip_exceeds_fare_or_total", "tip_amount > fare_amount or tip_amount > total_amount"),
    Rule("unknown_payment_type", "payment_type not in (1, 2, 3, 4, 5, 6)"),
    Rule("null_location_id", "pu_location_id is null or do_location_id is null"),
    Rule("duplicate_row", "dup_rank > 1"),
]


def first_match(rules: list[Rule]) -> Column:
    """The reason of the first rule that matches, null if none does."""
    out = None
    for r in rules:
        out = F.when(F.expr(r.when), r.reason) if out is None else out.when(F.expr(r.when), r.reason)
    return F.lit(None).cast("string") if out is None else out


def classify(df: DataFrame, rules: list[Rule] = TRIP_RULES) -> DataFrame:
    """Adds invalid_reason and is_valid. A null in a compared column matches no rule but those that ask
    for nulls, so such a row stays valid."""
    return df.withColumn("invalid_reason", first_match(rules)).withColumn("is_valid", F.col("invalid_reason").isNull())


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) of classified rows: every row is in exactly one of them."""
    return df.where("is_valid"), df.where("not is_valid")
