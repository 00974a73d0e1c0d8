"""Deterministic choice among rows of one natural key. The ladder of preferences is data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstrata.functions.keys import TRIP_IDS
from cabstrata.operators.windows import first_per_group


@dataclass(frozen=True)
class Ladder:
    """leading: columns, a '-' before one means descending (nulls are last either way); checks: SQL
    predicates, rows that satisfy one come before those that fail it or leave it unknown; columns: in
    ascending order, nulls last."""

    leading: list[str] = field(default_factory=list)
    checks: list[str] = field(default_factory=list)
    columns: list[str] = field(default_factory=list)

    def order(self) -> list[Column]:
        lead = [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in self.leading]
        checks = [F.when(F.expr(p), 0).otherwise(1) for p in self.checks]
        return [*lead, *checks, *[F.col(c).asc_nulls_last() for c in self.columns]]


# Ranges that plausible records keep, and the order of columns that breaks further ties.
PLAUSIBLE = [
    "payment_type in (1, 2, 3, 4, 5, 6)", "fare_amount between 0 and 1000", "total_amount between 0 and 1000",
    "trip_distance > 0 and trip_distance <= 200", "tip_amount <= fare_amount and tip_amount <= total_amount",
]
TIE_COLUMNS = [
    "payment_type", "fare_amount", "tip_amount", "total_amount", "passenger_count", "trip_distance", "extra", "mta_tax", "tolls_amount",
    "improvement_surcharge", "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "RatecodeID", "store_and_fwd_flag",
]
LATEST_LOAD = Ladder(["-_loaded_at", "-_ingest_batch_id"], PLAUSIBLE, [*TIE_COLUMNS])
FIRST_FILE = Ladder(["_source_filename"], PLAUSIBLE, [*TIE_COLUMNS])


def dedupe_natural_key(df: DataFrame, ladder: Ladder, keys: list[str] = TRIP_IDS) -> DataFrame:
    """One row per key, null equal to null: the first on the ladder. Only rows equal in every column of
    the ladder are left to chance; add a unique column to rule that out."""
    return first_per_group(df, keys, ladder.order())
