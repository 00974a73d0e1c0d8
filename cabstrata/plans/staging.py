"""From raw loads to facts: snapshot, staging, facts and the rows set aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabstrata.functions.keys import second_text, surrogate_key, trip_key
from cabstrata.functions.scalars import guarded_ratio, iso_weekday, seconds_between
from cabstrata.operators import classify, dedupe, enrich

# Source column, name and type at the boundary.
BOUNDARY = [
    ("VendorID", "vendor_id", "int"), ("tpep_pickup_datetime", "pickup_ts", "timestamp_ntz"), ("tpep_dropoff_datetime", "dropoff_ts", "timestamp_ntz"),
    ("passenger_count", "passenger_count", "int"), ("trip_distance", "trip_distance", "double"), ("RatecodeID", "ratecode_id", "int"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "string"), ("PULocationID", "pu_location_id", "int"), ("DOLocationID", "do_location_id", "int"),
    ("payment_type", "payment_type", "int"), ("fare_amount", "fare_amount", "double"), ("extra", "extra", "double"), ("mta_tax", "mta_tax", "double"),
    ("tip_amount", "tip_amount", "double"), ("tolls_amount", "tolls_amount", "double"), ("improvement_surcharge", "improvement_surcharge", "double"),
    ("total_amount", "total_amount", "double"), ("congestion_surcharge", "congestion_surcharge", "double"), ("airport_fee", "airport_fee", "double"),
    ("cbd_congestion_fee", "cbd_congestion_fee", "double"), ("_source_filename", "source_filename", "string"), ("_loaded_at", "loaded_at", "timestamp"),
]
#: Settles which of several rows of a file counts as the first; what it leaves equal is classified alike.
REPEAT_ORDER = ["payment_type", "fare_amount", "tip_amount", "total_amount", "trip_distance"]
FACT = [
    "trip_bk", "vendor_id", "pickup_ts", "dropoff_ts", "pickup_date", "pickup_hour", "pickup_dow", "pickup_year", "pickup_month", "trip_duration_min",
    "passenger_count", "trip_distance", "ratecode_id", "store_and_fwd_flag", "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "tip_pct",
    "pu_location_id", "pu_borough", "pu_zone", "pu_service_zone", "do_location_id", "do_borough", "do_zone", "do_service_zone", "source_filename", "loaded_at",
]
QUARANTINE = ["quarantine_key", *FACT[1:-2], "invalid_reason", "source_filename", "loaded_at"]


def snapshot(bronze: DataFrame) -> DataFrame:
    """The current state of every trip: one row per trip_bk, the first on the ladder of the latest load."""
    ladder = dedupe.LATEST_LOAD
    if "_row_id" in bronze.columns:
        ladder = dedupe.Ladder(ladder.leading, ladder.checks, [*ladder.columns, "_row_id"])
    return dedupe.dedupe_natural_key(bronze, ladder).withColumn("trip_bk", trip_key())


def stage(snap: DataFrame) -> DataFrame:
    """Casts and renames once, derives durations, date parts and ratios, numbers repeated trips and
    classifies each row."""
    cast = snap.select("trip_bk", *[F.col(a).cast(t).alias(b) for a, b, t in BOUNDARY])
    pick, drop = F.col("pickup_ts"), F.col("dropoff_ts")
    derived = cast.withColumns({
        "trip_duration_min": seconds_between(pick, drop).cast("double") / F.lit(60.0), "pickup_date": F.to_date(pick), "pickup_hour": F.hour(pick),
        "pickup_dow": iso_weekday(F.to_date(pick)), "pickup_year": F.year(pick), "pickup_month": F.month(pick),
        "tip_pct": guarded_ratio(F.col("tip_amount"), F.col("fare_amount")),
        "dup_rank": F.row_number().over(Window.partitionBy("vendor_id", "pickup_ts", "dropoff_ts", "pu_location_id", "do_location_id").orderBy(F.col("source_filename").asc_nulls_last(), F.col("loaded_at").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in REPEAT_ORDER])),
    })
    return classify.classify(derived)


def in_month(df: DataFrame, year: int | None, month: int | None, or_undated: bool = False) -> DataFrame:
    """The scope of a run: a month, with rows of no date if asked for; everything on a first run."""
    if year is None:
        return df
    scope = (F.col("pickup_year") == year) & (F.col("pickup_month") == month)
    return df.where(scope | F.col("pickup_year").isNull()) if or_undated else df.where(scope)


def facts(staged: DataFrame, zones: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    valid = in_month(classify.split(staged)[0], year, month)
    return enrich.lookup_roles(valid, zones, "location_id", enrich.ZONE_ROLES).select(*FACT)


def quarantine(staged: DataFrame, zones: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Invalid rows with their reason and a key that is never null; rows without a date in every run."""
    bad = in_month(classify.split(staged)[1], year, month, or_undated=True)
    key = surrogate_key(F.col("vendor_id"), second_text(F.col("pickup_ts")), second_text(F.col("dropoff_ts")), F.col("pu_location_id"), F.col("do_location_id"), F.col("fare_amount").cast("decimal(18,4)"), F.col("total_amount").cast("decimal(18,4)"), F.col("source_filename"))
    return enrich.lookup_roles(bad.withColumn("quarantine_key", key), zones, "location_id", enrich.ZONE_ROLES).select(*QUARANTINE)
