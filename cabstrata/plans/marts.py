"""Aggregates over the facts. Money is summed in decimals, so results don't depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabstrata.functions.scalars import bins, exact_avg, exact_sum, minutes_boundary, minutes_fractional, over

# Distance bins.
DISTANCE_BINS = [(1, "0-1mi"), (3, "1-3mi"), (5, "3-5mi"), (10, "5-10mi"), (20, "10-20mi")]
LAST_BIN = "20mi+"
#: The rank of a mart's percentile is off by at most 1 / ACCURACY of a group's rows; a task keeps about as many
#: samples of a group. Exact ones, that can be put together over loads, are those of problem 3.
ACCURACY = 10_000


def trips(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def distance_bucket(c: Column) -> Column:
    return bins(c, DISTANCE_BINS, LAST_BIN)


def _rank(keys: list[str], by: str) -> Column:
    return F.rank().over(Window.partitionBy(*keys).orderBy(F.col(by).desc_nulls_last())).cast("bigint")


def built_now(mart: DataFrame) -> DataFrame:
    """Adds the time of the build, for a mart that is stored."""
    return mart.withColumn("mart_built_at", F.current_timestamp())


def zone_revenue_monthly(fact: DataFrame) -> DataFrame:
    g = fact.groupBy("pickup_year", "pickup_month", "pu_location_id").agg(
        F.max("pu_borough").alias("pu_borough"), F.max("pu_zone").alias("pu_zone"), trips("trip_count"), exact_sum(F.col("total_amount")).alias("gross_revenue"),
        exact_sum(F.col("fare_amount")).alias("fare_revenue"), exact_sum(F.col("tip_amount")).alias("tip_revenue"), exact_avg(F.col("total_amount")).alias("avg_revenue_per_trip"),
    )
    return g.withColumn("revenue_rank_in_month", _rank(["pickup_year", "pickup_month"], "gross_revenue"))


def zone_revenue_yearly(monthly: DataFrame) -> DataFrame:
    g = monthly.groupBy("pickup_year", "pu_location_id").agg(
        F.max("pu_borough").alias("pu_borough"), F.max("pu_zone").alias("pu_zone"), F.sum("trip_count").alias("trip_count"), exact_sum(F.col("gross_revenue")).alias("yearly_gross_revenue"),
        exact_sum(F.col("fare_revenue")).alias("yearly_fare_revenue"), exact_sum(F.col("tip_revenue")).alias("yearly_tip_revenue"),
    )
    g = g.withColumn("avg_revenue_per_trip", over(F.col("yearly_gross_revenue"), F.col("trip_count").cast("double")))
    return g.withColumn("yearly_revenue_rank", _rank(["pickup_year"], "yearly_gross_revenue"))


def hourly_demand_monthly(fact: DataFrame) -> DataFrame:
    return fact.groupBy("pickup_year", "pickup_month", "pickup_dow", "pickup_hour").agg(
        trips("trip_count"), exact_sum(F.col("total_amount")).alias("gross_revenue"), exact_avg(F.col("fare_amount")).alias("avg_fare"), exact_avg(F.col("total_amount")).alias("avg_total"),
        exact_avg(F.col("trip_distance")).alias("avg_distance"), exact_avg(F.col("trip_duration_min"), 6).alias("avg_duration_min"),
        F.percentile_approx("fare_amount", 0.5, ACCURACY).alias("p50_fare"), F.percentile_approx("fare_amount", 0.9, ACCURACY).alias("p90_fare"),
    )


def _weighted(value: str, weight: str = "trip_count") -> Column:
    return over(F.sum((F.col(value) * F.col(weight)).cast("decimal(28,12)")).cast("double"), F.sum(weight).cast("double"))


def hourly_demand_yearly(monthly: DataFrame) -> DataFrame:
    """Means weighted by trips; percentiles don't add up and are left out."""
    return monthly.groupBy("pickup_year", "pickup_dow", "pickup_hour").agg(
        F.sum("trip_count").alias("trip_count"), exact_sum(F.col("gross_revenue")).alias("gross_revenue"),
        *[_weighted(c).alias(c) for c in ("avg_fare", "avg_total", "avg_distance", "avg_duration_min")],
    )


def supply_gaps(fact: DataFrame, fractional: bool = False) -> DataFrame:
    """Gaps between pickups of a zone within a day. The window and the aggregate share one clustering on
    (date, zone)."""
    w = Window.partitionBy("pickup_date", "pu_location_id").orderBy("pickup_ts")
    minutes = minutes_fractional if fractional else minutes_boundary
    slim = fact.select("pickup_date", "pu_location_id", "pu_borough", "pu_zone", "pickup_ts")
    gap = slim.withColumn("gap_min", minutes(F.lag("pickup_ts").over(w), F.col("pickup_ts")))
    return gap.groupBy("pickup_date", "pu_location_id").agg(
        F.max("pu_borough").alias("pu_borough"), F.max("pu_zone").alias("pu_zone"), trips("trip_count"), F.max("gap_min").alias("longest_gap_min"), exact_avg(F.col("gap_min"), 6).alias("avg_gap_min"),
        F.count_if(F.col("gap_min") > 60).alias("gaps_gt_1h"), F.count_if(F.col("gap_min") > 180).alias("gaps_gt_3h"), F.min("pickup_ts").alias("first_pickup_ts"), F.max("pickup_ts").alias("last_pickup_ts"),
    )


def supply_gaps_yearly(daily: DataFrame) -> DataFrame:
    return daily.groupBy(F.year("pickup_date").alias("pickup_year"), "pu_location_id").agg(
        F.max("pu_borough").alias("pu_borough"), F.max("pu_zone").alias("pu_zone"), F.sum("trip_count").alias("total_trips"), F.count_distinct("pickup_date").alias("days_with_trips"),
        F.max("longest_gap_min").alias("longest_gap_min_year"), exact_avg(F.col("longest_gap_min"), 6).alias("avg_longest_gap_per_day"),
        F.count_if(F.col("gaps_gt_1h") > 0).alias("days_with_gap_over_60min"), F.count_if(F.col("gaps_gt_3h") > 0).alias("days_with_gap_over_3h"),
    )


def tip_behaviour_monthly(fact: DataFrame) -> DataFrame:
    credit = F.when(F.col("payment_type") == 1, F.col("tip_pct"))
    f = fact.withColumn("distance_bucket", distance_bucket(F.col("trip_distance"))).withColumn("_credit", credit)
    return f.groupBy("pickup_year", "pickup_month", "pu_location_id", "distance_bucket", "payment_type").agg(
        F.max("pu_borough").alias("pu_borough"), F.max("pu_zone").alias("pu_zone"), trips("trip_count"), exact_sum(F.col("fare_amount")).alias("total_fare_amount"), exact_sum(F.col("tip_amount")).alias("total_tip_amount"),
        exact_avg(F.col("fare_amount")).alias("avg_fare"), exact_avg(F.col("tip_amount")).alias("avg_tip"), exact_avg(F.col("_credit"), 9).alias("avg_tip_pct_credit"),
        F.percentile_approx("_credit", 0.5, ACCURACY).alias("p50_tip_pct_credit"), F.percentile_approx("_credit", 0.9, ACCURACY).alias("p90_tip_pct_credit"),
    )


def tip_behaviour_yearly(monthly: DataFrame) -> DataFrame:
    g = monthly.groupBy("pickup_year", "pu_location_id", "distance_bucket", "payment_type").agg(
        F.max("pu_borough").alias("pu_borough"), F.max("pu_zone").alias("pu_zone"), F.sum("trip_count").alias("trip_count"), exact_sum(F.col("total_fare_amount")).alias("total_fare_amount"),
        exact_sum(F.col("total_tip_amount")).alias("total_tip_amount"), _weighted("avg_tip_pct_credit").alias("avg_tip_pct_credit"),
    )
    n = F.col("trip_count").cast("double")
    return g.withColumn("avg_fare", over(F.col("total_fare_amount"), n)).withColumn("avg_tip", over(F.col("total_tip_amount"), n))


def daily_aggregate(rows: DataFrame) -> DataFrame:
    """Historical grain: date, hour, zone, payment."""
    return rows.groupBy("pickup_date", "pickup_hour", "pu_location_id", "payment_type").agg(
        trips("trip_count"), exact_sum(F.col("total_amount")).alias("gross_revenue"), exact_sum(F.col("fare_amount")).alias("total_fare"), exact_sum(F.col("tip_amount")).alias("total_tip"),
        exact_sum(F.col("trip_distance")).alias("total_distance_mi"), F.sum(F.round(F.col("trip_duration_min") * 60).cast("bigint")).alias("total_duration_sec"),
        F.approx_count_distinct("vendor_id").alias("distinct_vendors"),
    )


def tip_behaviour_daily(rows: DataFrame) -> DataFrame:
    """Historical grain: date, zone, distance bin, payment."""
    return rows.withColumn("distance_bucket", distance_bucket(F.col("trip_distance"))).groupBy("pickup_date", "pu_location_id", "distance_bucket", "payment_type").agg(
        trips("trip_count"), exact_sum(F.col("fare_amount")).alias("total_fare"), exact_sum(F.col("tip_amount")).alias("total_tip"), exact_sum(F.col("trip_distance")).alias("total_distance_mi")
    )
