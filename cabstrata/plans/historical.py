"""Year-scale pre-aggregates straight from raw files, and their combination with the live marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstrata.operators import classify, dedupe
from cabstrata.plans import marts, staging


def historical_trips(raw: DataFrame, year: int | None = None) -> DataFrame:
    """Valid trips, one per natural key. Duplicates are settled before validity is tested (the other way
    round the valid copy would always win), by the same classifier as the live path. With a year only
    trips of that year stay, so that replacing a year twice changes nothing."""
    ladder = dedupe.FIRST_FILE
    if "_row_id" in raw.columns:
        ladder = dedupe.Ladder(ladder.leading, ladder.checks, [*ladder.columns, "_row_id"])
    one = dedupe.dedupe_natural_key(raw, ladder).withColumn("trip_bk", F.lit(None).cast("string"))
    valid = classify.split(staging.stage(one))[0]
    if year is None:
        return valid
    return valid.where(F.col("pickup_date").between(F.to_date(F.lit(f"{year}-01-01")), F.to_date(F.lit(f"{year}-12-31"))))


def year_aggregates(trips: DataFrame) -> dict[str, DataFrame]:
    """The three historical tables of the same trips; cache the trips if all are to be written."""
    gaps = marts.supply_gaps(trips.withColumns({"pu_borough": F.lit(None).cast("string"), "pu_zone": F.lit(None).cast("string")}), fractional=True)
    return {"daily_agg": marts.daily_aggregate(trips), "supply_gaps": gaps.drop("pu_borough", "pu_zone"), "tip_behaviour": marts.tip_behaviour_daily(trips)}
