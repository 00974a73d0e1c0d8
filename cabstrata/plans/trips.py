"""Queries over the trip tables, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstrata.functions.keys import bare_etag, bare_name, trip_key
from cabstrata.operators import classify, dedupe, dq, enrich, scd2, upsert
from cabstrata.plans import consumer, historical, marts, pipeline, staging
from cabstrata.session import load

#: The year of most queries; even the smallest test tables hold the revenue year.
YEAR, REVENUE_YEAR = 2025, 2024
#: Loads before this batch id count as the first run of a history, all loads as the second.
CUT = "b2025"
FIRST_RUN, SECOND_RUN = "2025-01-01 00:00:00", "2026-06-01 00:00:00"
#: Floors of the consumer queries, for the test tables.
DAYS, TRIPS, TIP_TRIPS = 30, 100, 20
CHECKED = ["fare_amount", "total_amount", "payment_type", "passenger_count", "trip_distance", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "store_and_fwd_flag", "RatecodeID"]


def _fact(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "int_trips_enriched")


def _bronze(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "yellow_tripdata")


def _staged(spark: SparkSession, d: str) -> DataFrame:
    return staging.stage(staging.snapshot(_bronze(spark, d)))


def _years(df: DataFrame, *years: int) -> DataFrame:
    return df.where(F.col("pickup_year").isin(*years))


def zone_revenue_monthly(s, d):
    return marts.zone_revenue_monthly(_fact(s, d))


def zone_revenue_yearly(s, d):
    return marts.zone_revenue_yearly(zone_revenue_monthly(s, d))


def zone_revenue_rank_shift(s, d):
    monthly = marts.zone_revenue_monthly(_fact(s, d).where(F.col("pickup_year") == REVENUE_YEAR))
    return consumer.zone_revenue_rank_shift(monthly, marts.zone_revenue_yearly(monthly), REVENUE_YEAR)


def hourly_demand_monthly(s, d):
    return marts.hourly_demand_monthly(_fact(s, d))


def hourly_demand_yearly(s, d):
    return marts.hourly_demand_yearly(hourly_demand_monthly(s, d))


def hourly_peak_trough(s, d):
    return consumer.hourly_peak_trough(hourly_demand_yearly(s, d), YEAR)


def supply_gaps_daily(s, d):
    return marts.supply_gaps(_fact(s, d))


def supply_gaps_fractional(s, d):
    return marts.supply_gaps(_fact(s, d), fractional=True).drop("pu_borough", "pu_zone")


def supply_gaps_yearly(s, d):
    return marts.supply_gaps_yearly(supply_gaps_daily(s, d))


def underserved_zones(s, d):
    daily = supply_gaps_daily(s, d)
    return consumer.underserved_zones(daily, marts.supply_gaps_yearly(daily), YEAR, DAYS, TRIPS)


def tip_behaviour_monthly(s, d):
    return marts.tip_behaviour_monthly(_fact(s, d))


def tip_behaviour_yearly(s, d):
    return marts.tip_behaviour_yearly(tip_behaviour_monthly(s, d))


def tip_vs_city(s, d):
    return consumer.tip_vs_city(tip_behaviour_yearly(s, d), YEAR, TIP_TRIPS)


def dedupe_natural_key(s, d):
    return staging.snapshot(_bronze(s, d)).select("trip_bk", "_row_id", "_ingest_batch_id", "fare_amount", "payment_type")


def dedupe_by_file(s, d):
    ladder = dedupe.Ladder(dedupe.FIRST_FILE.leading, dedupe.FIRST_FILE.checks, [*dedupe.FIRST_FILE.columns, "_row_id"])
    return dedupe.dedupe_natural_key(_bronze(s, d), ladder).select("_row_id", "_source_filename", "fare_amount", "payment_type")


def surrogate_key(s, d):
    return _bronze(s, d).select("_row_id", trip_key().alias("trip_bk"))


def classify_rows(s, d):
    return _staged(s, d).select("trip_bk", "pickup_year", "pickup_month", "pickup_dow", "invalid_reason", "is_valid")


def classify_repeats(s, d):
    """Every raw row, repeats included: the rule for repeated rows applies only before they are settled."""
    rows = _bronze(s, d).withColumn("trip_bk", F.lit(None).cast("string"))
    return staging.stage(rows).groupBy("invalid_reason").agg(F.count(F.lit(1)).alias("n"))


def fact_trips(s, d):
    f = staging.facts(_staged(s, d), load(s, d, "dim_zones"))
    return f.select("trip_bk", "pickup_ts", "pickup_dow", F.round(F.col("trip_duration_min") * 60).cast("bigint").alias("duration_sec"), "total_amount", "pu_zone", "do_zone", "pu_borough", "do_service_zone")


def quarantine_rows(s, d):
    q = staging.quarantine(_staged(s, d), load(s, d, "dim_zones"))
    return q.select("quarantine_key", "invalid_reason", "pickup_year", "pu_zone", "do_zone")


def quarantine_share(s, d):
    return consumer.quarantine_share(staging.quarantine(_staged(s, d), load(s, d, "dim_zones")))


def quarantine_coverage(s, d):
    return consumer.coverage(staging.quarantine(_staged(s, d), load(s, d, "dim_zones")), "quarantined_trip_count", True).drop("gross_revenue_usd")


def month_scope_with_undated(s, d):
    q = staging.quarantine(_staged(s, d), load(s, d, "dim_zones"), YEAR, 3)
    return q.groupBy("pickup_year", "invalid_reason").agg(F.count(F.lit(1)).alias("n"))


def enrich_role_playing(s, d):
    bare = _fact(s, d).select("trip_bk", "pu_location_id", "do_location_id")
    return enrich.lookup_roles(bare, load(s, d, "dim_zones"), "location_id", enrich.ZONE_ROLES)


def daily_agg_historical(s, d):
    """The number of vendors is an estimate; of a handful of them it is exact."""
    return marts.daily_aggregate(historical.historical_trips(_bronze(s, d)))


def daily_agg_of_a_year(s, d):
    return historical.year_aggregates(historical.historical_trips(_bronze(s, d), YEAR))["daily_agg"]


def tip_behaviour_historical(s, d):
    return _hist(s, d)["tip_behaviour"]


def supply_gaps_historical(s, d):
    return _hist(s, d)["supply_gaps"]


def _hist(s, d):
    # All years from the raw loads; the live marts hold most of it as well and win.
    return historical.year_aggregates(historical.historical_trips(_bronze(s, d)))


def _live(s, d):
    return _fact(s, d)


def union_priority_q1(s, d):
    return consumer.union_zone_revenue(marts.zone_revenue_monthly(_live(s, d)), _hist(s, d)["daily_agg"])


def union_priority_q2(s, d):
    return consumer.union_hourly_demand(marts.hourly_demand_monthly(_live(s, d)), _hist(s, d)["daily_agg"])


def union_priority_q3(s, d):
    return consumer.union_supply_gaps(marts.supply_gaps(_live(s, d)), _hist(s, d)["supply_gaps"], DAYS, TRIPS)


def union_priority_q4(s, d):
    return consumer.union_tip_behaviour(marts.tip_behaviour_monthly(_live(s, d)), _hist(s, d)["tip_behaviour"], TIP_TRIPS)


def _scd2(s, d):
    cols = ["trip_bk", *CHECKED]
    first = staging.snapshot(_bronze(s, d).where(F.col("_ingest_batch_id") < CUT)).select(*cols)
    return scd2.scd2_apply(scd2.scd2_start(first, FIRST_RUN), staging.snapshot(_bronze(s, d)).select(*cols), "trip_bk", CHECKED, SECOND_RUN)


def scd2_versions(s, d):
    return _scd2(s, d).select("trip_bk", "fare_amount", "payment_type", "valid_from", "valid_to")


def scd2_current(s, d):
    return _scd2(s, d).where("valid_to is null").select("trip_bk", "fare_amount", "tip_amount", "valid_from")


def scd2_health(s, d):
    return consumer.scd2_health(_scd2(s, d), "trip_bk")


def merge_upsert(s, d):
    cols = ["trip_bk", "fare_amount", "total_amount", "_ingest_batch_id"]
    old = staging.snapshot(_bronze(s, d).where(F.col("_ingest_batch_id") < CUT)).select(*cols)
    new = staging.snapshot(_bronze(s, d).where(F.col("_ingest_batch_id") >= CUT)).select(*cols)
    return upsert.merge_upsert(old, new, ["trip_bk"])


def _stale_and_new(s, d):
    g = ["pickup_year", "pickup_month", "pu_location_id"]
    count = F.count(F.lit(1)).alias("trip_count")
    f = _fact(s, d)
    return f.where("loaded_at < timestamp'2025-06-01 00:00:00'").groupBy(*g).agg(count), f.where(F.col("pickup_year") == YEAR).groupBy(*g).agg(count), g


def delete_insert_scope(s, d):
    stale, new, keys = _stale_and_new(s, d)
    return upsert.delete_insert(stale, new, keys)


def replace_scope(s, d):
    stale, new, _ = _stale_and_new(s, d)
    return upsert.replace_scope(stale, new, f"pickup_year = {YEAR}")


def partition_replace(s, d):
    b = _bronze(s, d)
    return upsert.delete_by_file(b, "yellow_tripdata_2025-05_s0007.parquet", "_source_filename").groupBy("_ingest_batch_id").agg(F.count(F.lit(1)).alias("n"))


def bronze_load_audit(s, d):
    return consumer.bronze_load_audit(_bronze(s, d))


def coverage_by_month(s, d):
    return consumer.coverage(_fact(s, d), "valid_trip_count")


def top_zones(s, d):
    return consumer.top_zones(_fact(s, d))


def month_over_month_anomalies(s, d):
    return dq.period_counts(_fact(s, d), ["pickup_year", "pickup_month"], 0.05, 100)


def fact_mart_reconciliation(s, d):
    """The monthly mart as of the loads before June 2025, against all facts: months still to be rebuilt."""
    f = _fact(s, d)
    stale = marts.zone_revenue_monthly(f.where("loaded_at < timestamp'2025-06-01 00:00:00'"))
    return dq.reconcile(f, stale, ["pickup_year", "pickup_month"], "zone_revenue_monthly")


def pending_rebuilds(s, d):
    """The four marts as of the loads before June 2025, against all facts."""
    f = _fact(s, d)
    old = f.where("loaded_at < timestamp'2025-06-01 00:00:00'")
    made = {
        "agg_hourly_demand_monthly": marts.hourly_demand_monthly, "agg_zone_revenue_monthly": marts.zone_revenue_monthly,
        "agg_zone_tip_behaviour_monthly": marts.tip_behaviour_monthly, "agg_zone_supply_gaps_daily": marts.supply_gaps,
    }
    return dq.reconcile_all(f, pipeline.monthly_marts(lambda m: made[m](old)), ["pickup_year", "pickup_month"])


def dq_not_null(s, d):
    return dq.not_null(_bronze(s, d), "_loaded_at").select("_row_id")


def dq_duplicate_keys(s, d):
    return dq.unique(_bronze(s, d).withColumn("trip_bk", trip_key()), ["trip_bk"])


def dq_unique_combination(s, d):
    return dq.unique(_bronze(s, d), ["_source_filename", "tpep_pickup_datetime", "PULocationID"])


def dq_accepted_values(s, d):
    return dq.accepted_values(_bronze(s, d), "payment_type", [1, 2, 3, 4, 5, 6]).select("_row_id", "payment_type")


def dq_orphans(s, d):
    return dq.relationships(_bronze(s, d), "PULocationID", load(s, d, "dim_zones"), "location_id").select("_row_id", "PULocationID")


def dq_out_of_range(s, d):
    return dq.in_range(_bronze(s, d), "fare_amount", 0, 1000, only="payment_type = 1").select("_row_id", "fare_amount")


def dq_duration_sane(s, d):
    return dq.duration_sane(_staged(s, d), "trip_duration_min", 720, only="payment_type is not null").select("trip_bk")


def dq_one_current(s, d):
    h = load(s, d, "snp_yellow_trips").withColumn("valid_to", F.col("dbt_valid_to"))
    return dq.one_current(h, "trip_bk")


def source_freshness(s, d):
    return dq.freshness(_bronze(s, d), "_loaded_at", "2026-02-15 00:00:00")


def fingerprint_state(s, d):
    """The state of files as of each name's last record before the newest snapshot, against that one."""
    f = load(s, d, "source_fingerprints").select("snapshot_id", bare_name(F.col("filename")).alias("filename"), bare_etag(F.col("etag")).alias("etag"), "recorded_at")
    newest = f.select(F.max("snapshot_id").alias("m")).scalar()
    state = f.where(F.col("snapshot_id") < newest).groupBy("filename").agg(F.max(F.struct("snapshot_id", "recorded_at", "etag")).alias("s")).select("filename", F.col("s.etag").alias("stored"))
    now = f.where(F.col("snapshot_id") == newest).groupBy("filename").agg(F.max(F.struct("recorded_at", "etag")).alias("s")).select("filename", F.col("s.etag").alias("etag"))
    status = F.when(F.col("etag").isNull(), "not_published").when(F.col("stored").isNull(), "new").when(F.col("etag") == F.col("stored"), "unchanged").otherwise("drifted")
    return now.join(state, "filename", "full_outer").select("filename", status.alias("status"))


QUERIES = {
    f.__name__: f
    for f in (
        zone_revenue_rank_shift, zone_revenue_monthly, zone_revenue_yearly, hourly_demand_monthly, hourly_demand_yearly, hourly_peak_trough, supply_gaps_daily,
        supply_gaps_fractional, supply_gaps_yearly, underserved_zones, tip_behaviour_monthly, tip_behaviour_yearly, tip_vs_city, dedupe_natural_key, dedupe_by_file,
        surrogate_key, classify_rows, classify_repeats, fact_trips, quarantine_rows, quarantine_share, quarantine_coverage, month_scope_with_undated, enrich_role_playing,
        daily_agg_historical, daily_agg_of_a_year, tip_behaviour_historical, supply_gaps_historical, union_priority_q1, union_priority_q2, union_priority_q3,
        union_priority_q4, scd2_versions, scd2_current, scd2_health, merge_upsert, delete_insert_scope, replace_scope, partition_replace, bronze_load_audit,
        coverage_by_month, top_zones, month_over_month_anomalies, fact_mart_reconciliation, pending_rebuilds, dq_not_null, dq_duplicate_keys, dq_unique_combination, dq_accepted_values,
        dq_orphans, dq_out_of_range, dq_duration_sane, dq_one_current, source_freshness, fingerprint_state,
    )
}
