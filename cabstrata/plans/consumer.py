"""Consumer queries over the marts, and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabstrata.functions.scalars import exact_avg, exact_sum, iso_weekday, over, rounded
from cabstrata.operators.union import priority_union
from cabstrata.operators.windows import first_per_group, shifted

LIVE, HISTORICAL = "live", "historical"


def zone_revenue_rank_shift(monthly: DataFrame, yearly: DataFrame, year: int, k: int = 20) -> DataFrame:
    """The first k zones of each month with their rank in the month before. The rank before is taken
    among all zones of the year, not among the first k."""
    m = shifted(monthly.where(F.col("pickup_year") == year), ["pu_location_id"], ["pickup_year", "pickup_month"], "revenue_rank_in_month", "prev_month_rank")
    y = yearly.where(F.col("pickup_year") == year).select("pickup_year", "pu_location_id", "yearly_gross_revenue", "yearly_revenue_rank")
    j = m.join(y, ["pickup_year", "pu_location_id"]).where(F.col("revenue_rank_in_month") <= k)
    return j.select(
        "pickup_year", "pickup_month", "pu_location_id", "pu_borough", "pu_zone", "trip_count", rounded(F.col("gross_revenue"), 2).alias("gross_revenue_usd"), "revenue_rank_in_month", "prev_month_rank",
        F.coalesce(F.col("prev_month_rank") - F.col("revenue_rank_in_month"), F.lit(0).cast("bigint")).alias("rank_change_vs_prev_month"), rounded(F.col("yearly_gross_revenue"), 2).alias("yearly_gross_revenue_usd"), "yearly_revenue_rank",
    ).orderBy("pickup_month", "revenue_rank_in_month")


def hourly_peak_trough(yearly: DataFrame, year: int) -> DataFrame:
    d = Window.partitionBy("pickup_dow")
    y = yearly.where(F.col("pickup_year") == year)
    extreme = F.when(F.col("trip_count") == F.max("trip_count").over(d), "peak").when(F.col("trip_count") == F.min("trip_count").over(d), "trough")
    return y.select(
        "pickup_dow", "pickup_hour", "trip_count", rounded(F.col("avg_fare"), 2, 6).alias("avg_fare_usd"), rounded(F.col("avg_total"), 2, 6).alias("avg_total_usd"), rounded(F.col("avg_distance"), 2, 6).alias("avg_distance_mi"),
        rounded(F.col("avg_duration_min"), 1, 6).alias("avg_duration_min"), extreme.alias("dow_extreme"), F.rank().over(d.orderBy(F.col("trip_count").desc())).cast("bigint").alias("dow_trip_rank"),
    ).orderBy("pickup_dow", "pickup_hour")


def underserved_zones(daily: DataFrame, yearly: DataFrame, year: int, days: int = 30, trips: int = 1000, k: int = 50) -> DataFrame:
    """Zones by days with long gaps, with their worst day. A day without any gap isn't the worst."""
    in_year = daily.where(F.col("pickup_date").between(F.to_date(F.lit(f"{year}-01-01")), F.to_date(F.lit(f"{year}-12-31"))))
    worst = first_per_group(in_year, ["pu_location_id"], [F.col("longest_gap_min").desc_nulls_last(), F.col("pickup_date")])
    worst = worst.select("pu_location_id", F.col("pickup_date").alias("worst_day"), F.col("longest_gap_min").alias("worst_day_longest_gap_min"), F.col("trip_count").alias("worst_day_trip_count"))
    y = yearly.where((F.col("pickup_year") == year) & (F.col("days_with_trips") >= days) & (F.col("total_trips") >= trips))
    rank = F.rank().over(Window.partitionBy(F.lit(0)).orderBy(F.col("days_with_gap_over_3h").desc(), F.col("avg_longest_gap_per_day").desc_nulls_last())).cast("bigint")
    j = y.join(worst, "pu_location_id", "left").withColumn("underserved_rank", rank)
    return j.select(
        "pu_borough", "pu_zone", "pu_location_id", "days_with_trips", "total_trips", rounded(F.col("avg_longest_gap_per_day"), 1, 6).alias("avg_daily_longest_gap_min"), F.col("longest_gap_min_year").alias("worst_observed_gap_min"),
        "days_with_gap_over_60min", "days_with_gap_over_3h", "worst_day", "worst_day_longest_gap_min", "worst_day_trip_count", "underserved_rank",
    ).orderBy("underserved_rank", "pu_location_id").limit(k)


def tip_vs_city(yearly: DataFrame, year: int, trips: int = 1000) -> DataFrame:
    """A zone's mean tip share against the unweighted mean over zones of its distance bin."""
    y = yearly.where((F.col("pickup_year") == year) & (F.col("payment_type") == 1) & (F.col("trip_count") >= trips))
    own, bucket = F.col("avg_tip_pct_credit"), Window.partitionBy("distance_bucket")
    y = y.withColumn("_city", F.sum(own.cast("decimal(18,12)")).over(bucket).cast("double") / F.count(own).over(bucket).cast("double"))
    return y.select(
        "pu_location_id", "pu_borough", "pu_zone", "distance_bucket", "trip_count", rounded(own * 100, 2).alias("avg_tip_pct"), rounded(F.col("_city") * 100, 2).alias("city_avg_tip_pct"),
        rounded((own - F.col("_city")) * 100, 2).alias("tip_pct_deviation_pp"), rounded(F.col("avg_tip"), 2, 6).alias("avg_tip_usd"),
    ).orderBy("distance_bucket", F.col("tip_pct_deviation_pp").desc())


def union_zone_revenue(live_monthly: DataFrame, daily_agg: DataFrame, k: int = 20) -> DataFrame:
    keys = ["pickup_year", "pickup_month", "pu_location_id"]
    live = live_monthly.groupBy(*keys).agg(F.sum("trip_count").alias("trip_count"), exact_sum(F.col("gross_revenue")).alias("gross_revenue"))
    hist = daily_agg.groupBy(F.year("pickup_date").alias("pickup_year"), F.month("pickup_date").alias("pickup_month"), "pu_location_id").agg(F.sum("trip_count").alias("trip_count"), exact_sum(F.col("gross_revenue")).alias("gross_revenue"))
    both = priority_union({LIVE: live, HISTORICAL: hist}, keys)
    rank = F.rank().over(Window.partitionBy("pickup_year", "pickup_month").orderBy(F.col("gross_revenue").desc_nulls_last())).cast("bigint")
    return both.withColumn("revenue_rank_in_month", rank).where(F.col("revenue_rank_in_month") <= k).select(*keys, "trip_count", rounded(F.col("gross_revenue"), 0).alias("revenue_usd"), "revenue_rank_in_month", "source")


def union_hourly_demand(live_monthly: DataFrame, daily_agg: DataFrame) -> DataFrame:
    keys = ["pickup_year", "pickup_month", "pickup_dow", "pickup_hour"]
    live = live_monthly.select(*keys, "trip_count", (F.col("avg_fare") * F.col("trip_count")).alias("fare"))
    d = F.col("pickup_date")
    hist = daily_agg.groupBy(F.year(d).alias("pickup_year"), F.month(d).alias("pickup_month"), iso_weekday(d).alias("pickup_dow"), "pickup_hour").agg(F.sum("trip_count").alias("trip_count"), exact_sum(F.col("total_fare")).alias("fare"))
    both = priority_union({LIVE: live, HISTORICAL: hist}, keys)
    return both.groupBy("pickup_year", "pickup_dow", "pickup_hour").agg(F.sum("trip_count").alias("trip_count"), rounded(over(exact_sum(F.col("fare"), 6), F.sum("trip_count").cast("double")), 2, 6).alias("avg_fare_usd"))


def union_supply_gaps(live_daily: DataFrame, hist_daily: DataFrame, days: int = 30, trips: int = 1000, k: int = 20) -> DataFrame:
    cols = ["pickup_date", "pu_location_id", "trip_count", F.col("longest_gap_min").cast("double").alias("longest_gap_min"), "gaps_gt_1h", "gaps_gt_3h"]
    both = priority_union({LIVE: live_daily.select(*cols), HISTORICAL: hist_daily.select(*cols)}, ["pickup_date", "pu_location_id"]).where("pu_location_id is not null")
    g = both.groupBy(F.year("pickup_date").alias("pickup_year"), "pu_location_id").agg(
        F.count_distinct("pickup_date").alias("days_with_trips"), F.sum("trip_count").alias("total_trips"), rounded(F.max("longest_gap_min"), 0, 6).alias("longest_gap_min_year"), exact_avg(F.col("longest_gap_min"), 6).alias("_avg"),
        F.count_if(F.col("gaps_gt_1h") > 0).alias("days_with_gap_over_60min"), F.count_if(F.col("gaps_gt_3h") > 0).alias("days_with_gap_over_3h"),
    )
    g = g.where((F.col("days_with_trips") >= days) & (F.col("total_trips") >= trips))
    rank = F.rank().over(Window.partitionBy("pickup_year").orderBy(F.col("days_with_gap_over_3h").desc(), F.col("_avg").desc_nulls_last())).cast("bigint")
    return g.withColumn("underserved_rank", rank).where(F.col("underserved_rank") <= k).withColumn("avg_longest_gap_per_day", rounded(F.col("_avg"), 1, 6)).drop("_avg")


def union_tip_behaviour(live_monthly: DataFrame, tip_daily: DataFrame, trips: int = 1000) -> DataFrame:
    keys = ["pickup_year", "pickup_month", "pu_location_id", "distance_bucket", "payment_type"]
    live = live_monthly.select(*keys, "trip_count", F.col("total_fare_amount").alias("total_fare"), F.col("total_tip_amount").alias("total_tip"))
    d = F.col("pickup_date")
    hist = tip_daily.groupBy(F.year(d).alias("pickup_year"), F.month(d).alias("pickup_month"), *keys[2:]).agg(F.sum("trip_count").alias("trip_count"), exact_sum(F.col("total_fare")).alias("total_fare"), exact_sum(F.col("total_tip")).alias("total_tip"))
    g = priority_union({LIVE: live, HISTORICAL: hist}, keys).where("payment_type = 1").groupBy("pickup_year", *keys[2:]).agg(F.sum("trip_count").alias("trip_count"), exact_sum(F.col("total_fare")).alias("_fare"), exact_sum(F.col("total_tip")).alias("_tip"))
    g = g.where(F.col("trip_count") >= trips)
    return g.select("pickup_year", *keys[2:], "trip_count", rounded(over(F.col("_tip"), F.col("_fare")) * 100, 2).alias("avg_tip_pct"), rounded(over(F.col("_tip"), F.col("trip_count").cast("double")), 2).alias("avg_tip_usd"))


def bronze_load_audit(bronze: DataFrame) -> DataFrame:
    g = bronze.groupBy("_loaded_by").agg(F.count(F.lit(1)).alias("rows_loaded"), F.count_distinct("_ingest_batch_id").alias("distinct_load_events"), F.min("_loaded_at").alias("first_load"), F.max("_loaded_at").alias("last_load"))
    return g.orderBy(F.col("last_load").desc_nulls_last())


def scd2_health(history: DataFrame, key: str) -> DataFrame:
    return history.agg(
        F.count_distinct(key).alias("unique_keys"), F.count(F.lit(1)).alias("total_rows"), F.coalesce(F.sum(F.when(F.col("valid_to").isNull(), 1).otherwise(0)), F.lit(0)).alias("current_versions"), F.count_distinct(F.when(F.col("valid_to").isNotNull(), F.col(key))).alias("keys_with_closed_versions")
    )


def top_zones(fact: DataFrame, k: int = 10) -> DataFrame:
    g = fact.groupBy("pu_borough", "pu_zone").agg(F.count(F.lit(1)).alias("trips"), exact_sum(F.col("total_amount")).alias("_sum"), exact_avg(F.col("total_amount")).alias("_avg"), exact_avg(F.col("tip_pct"), 9).alias("_tip"))
    g = g.orderBy(F.col("_sum").desc_nulls_last(), "pu_borough", "pu_zone").limit(k)
    return g.select("pu_borough", "pu_zone", "trips", rounded(F.col("_sum"), 0).alias("gross_revenue_usd"), rounded(F.col("_avg"), 2).alias("avg_fare_usd"), rounded(F.col("_tip") * 100, 1).alias("avg_tip_pct"))


def quarantine_share(quarantine: DataFrame) -> DataFrame:
    g = quarantine.groupBy("invalid_reason").agg(F.count(F.lit(1)).alias("rows_quarantined"))
    share = F.lit(100.0) * F.col("rows_quarantined") / F.sum("rows_quarantined").over(Window.partitionBy(F.lit(0)))
    return g.withColumn("pct_of_quarantined", rounded(share, 3)).orderBy(F.col("rows_quarantined").desc())


def coverage(rows: DataFrame, count: str = "trip_count", dated_only: bool = False) -> DataFrame:
    g = rows.groupBy("pickup_year", "pickup_month").agg(F.count(F.lit(1)).alias(count), rounded(exact_sum(F.col("total_amount")), 0).alias("gross_revenue_usd"), F.min("pickup_date").alias("first_pickup_date"), F.max("pickup_date").alias("last_pickup_date"))
    return (g.where("pickup_year is not null") if dated_only else g).orderBy("pickup_year", "pickup_month")
