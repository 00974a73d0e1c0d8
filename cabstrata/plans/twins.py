"""SQL for DuckDB that says the same as the queries of trips.py, written apart from them."""

from __future__ import annotations

YEAR, REVENUE_YEAR = 2025, 2024
IDS = "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID"
CHECKED = "fare_amount, total_amount, payment_type, passenger_count, trip_distance, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, congestion_surcharge, airport_fee, cbd_congestion_fee, store_and_fwd_flag, RatecodeID"
BK = "md5(concat_ws('-', coalesce(VendorID::VARCHAR, '_null_'), coalesce(strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S'), '_null_'), coalesce(strftime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S'), '_null_'), coalesce(PULocationID::VARCHAR, '_null_'), coalesce(DOLocationID::VARCHAR, '_null_')))"
LADDER = """(payment_type IN (1, 2, 3, 4, 5, 6)) IS NOT TRUE, (fare_amount BETWEEN 0 AND 1000) IS NOT TRUE, (total_amount BETWEEN 0 AND 1000) IS NOT TRUE,
  (trip_distance > 0 AND trip_distance <= 200) IS NOT TRUE, (tip_amount <= fare_amount AND tip_amount <= total_amount) IS NOT TRUE,
  payment_type NULLS LAST, fare_amount NULLS LAST, tip_amount NULLS LAST, total_amount NULLS LAST, passenger_count NULLS LAST, trip_distance NULLS LAST, extra NULLS LAST,
  mta_tax NULLS LAST, tolls_amount NULLS LAST, improvement_surcharge NULLS LAST, congestion_surcharge NULLS LAST, airport_fee NULLS LAST, cbd_congestion_fee NULLS LAST,
  RatecodeID NULLS LAST, store_and_fwd_flag NULLS LAST, _row_id"""


def snap(where: str = "true") -> str:
    return f"SELECT {BK} AS trip_bk, * FROM yellow_tripdata WHERE {where} QUALIFY row_number() OVER (PARTITION BY {IDS} ORDER BY _loaded_at DESC NULLS LAST, _ingest_batch_id DESC NULLS LAST, {LADDER}) = 1"


BY_FILE = f"SELECT 'x' AS trip_bk, * FROM yellow_tripdata QUALIFY row_number() OVER (PARTITION BY {IDS} ORDER BY _source_filename NULLS LAST, {LADDER}) = 1"


def money(c: str) -> str:
    return f"sum({c}::DECIMAL(18,4))::DOUBLE"


def mean(c: str, digits: int = 4) -> str:
    return f"(sum({c}::DECIMAL(18,{digits}))::DOUBLE / nullif(count({c}), 0)::DOUBLE)"


def rnd(c: str, digits: int, scale: int = 9) -> str:
    return f"round({c}::DECIMAL(30,{scale}), {digits})::DOUBLE"

REPEATS = "_loaded_at DESC NULLS LAST, payment_type NULLS LAST, fare_amount NULLS LAST, tip_amount NULLS LAST, total_amount NULLS LAST, trip_distance NULLS LAST"


def staged(src: str) -> str:
    return f"""
src AS ({src}),
st0 AS (SELECT trip_bk, VendorID AS vendor_id, tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts, trip_distance::DOUBLE AS trip_distance, PULocationID AS pu_location_id, DOLocationID AS do_location_id,
  payment_type, fare_amount::DOUBLE AS fare_amount, tip_amount::DOUBLE AS tip_amount, total_amount::DOUBLE AS total_amount, _source_filename AS source_filename,
  date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime)::DOUBLE / 60.0::DOUBLE AS trip_duration_min, tpep_pickup_datetime::DATE AS pickup_date, hour(tpep_pickup_datetime)::INT AS pickup_hour,
  isodow(tpep_pickup_datetime)::INT AS pickup_dow, year(tpep_pickup_datetime)::INT AS pickup_year, month(tpep_pickup_datetime)::INT AS pickup_month,
  CASE WHEN fare_amount > 0 THEN tip_amount::DOUBLE / fare_amount::DOUBLE END AS tip_pct,
  row_number() OVER (PARTITION BY {IDS} ORDER BY _source_filename NULLS LAST, {REPEATS}) AS dup_rank FROM src),
st AS (SELECT *, CASE WHEN pickup_ts IS NULL OR dropoff_ts IS NULL THEN 'null_timestamp' WHEN pickup_ts >= dropoff_ts THEN 'pickup_ge_dropoff' WHEN trip_duration_min > 720 THEN 'duration_out_of_range'
  WHEN trip_distance IS NULL OR trip_distance <= 0 THEN 'non_positive_distance' WHEN trip_distance > 200 THEN 'distance_out_of_range' WHEN fare_amount < 0 OR total_amount < 0 THEN 'negative_fare_or_total'
  WHEN fare_amount > 1000 OR total_amount > 1000 THEN 'excessive_fare_or_total' WHEN tip_amount > fare_amount OR tip_amount > total_amount THEN 'tip_exceeds_fare_or_total'
  WHEN payment_type NOT IN (1, 2, 3, 4, 5, 6) THEN 'unknown_payment_type' WHEN pu_location_id IS NULL OR do_location_id IS NULL THEN 'null_location_id' WHEN dup_rank > 1 THEN 'duplicate_row' END AS invalid_reason FROM st0)"""


STAGED = "WITH" + staged(snap())
HIST = staged(BY_FILE) + ",\nh AS (SELECT * FROM st WHERE invalid_reason IS NULL)"
HIST_YEAR = staged(BY_FILE) + f",\nh AS (SELECT * FROM st WHERE invalid_reason IS NULL AND pickup_date BETWEEN DATE '{YEAR}-01-01' AND DATE '{YEAR}-12-31')"
BUCKET = "CASE WHEN trip_distance <= 1 THEN '0-1mi' WHEN trip_distance <= 3 THEN '1-3mi' WHEN trip_distance <= 5 THEN '3-5mi' WHEN trip_distance <= 10 THEN '5-10mi' WHEN trip_distance <= 20 THEN '10-20mi' ELSE '20mi+' END"

ZM = f"""zm AS (SELECT pickup_year, pickup_month, pu_location_id, max(pu_borough) AS pu_borough, max(pu_zone) AS pu_zone, count(*) AS trip_count, {money("total_amount")} AS gross_revenue,
  {money("fare_amount")} AS fare_revenue, {money("tip_amount")} AS tip_revenue, {mean("total_amount")} AS avg_revenue_per_trip, rank() OVER (PARTITION BY pickup_year, pickup_month ORDER BY {money("total_amount")} DESC NULLS LAST) AS revenue_rank_in_month
  FROM fact GROUP BY pickup_year, pickup_month, pu_location_id)"""
ZY = f"""zy AS (SELECT pickup_year, pu_location_id, max(pu_borough) AS pu_borough, max(pu_zone) AS pu_zone, sum(trip_count)::BIGINT AS trip_count, {money("gross_revenue")} AS yearly_gross_revenue,
  {money("fare_revenue")} AS yearly_fare_revenue, {money("tip_revenue")} AS yearly_tip_revenue, {money("gross_revenue")} / nullif(sum(trip_count), 0)::DOUBLE AS avg_revenue_per_trip,
  rank() OVER (PARTITION BY pickup_year ORDER BY {money("gross_revenue")} DESC NULLS LAST) AS yearly_revenue_rank FROM zm GROUP BY pickup_year, pu_location_id)"""
HM = f"""hm AS (SELECT pickup_year, pickup_month, pickup_dow, pickup_hour, count(*) AS trip_count, {money("total_amount")} AS gross_revenue, {mean("fare_amount")} AS avg_fare, {mean("total_amount")} AS avg_total,
  {mean("trip_distance")} AS avg_distance, {mean("trip_duration_min", 6)} AS avg_duration_min, quantile_disc(fare_amount, 0.5) AS p50_fare, quantile_disc(fare_amount, 0.9) AS p90_fare FROM fact GROUP BY 1, 2, 3, 4)"""


def weighted(c: str) -> str:
    return f"sum(({c} * trip_count)::DECIMAL(28,12))::DOUBLE / nullif(sum(trip_count), 0)::DOUBLE AS {c}"


HY = f"hy AS (SELECT pickup_year, pickup_dow, pickup_hour, sum(trip_count)::BIGINT AS trip_count, {money('gross_revenue')} AS gross_revenue, {', '.join(map(weighted, ('avg_fare', 'avg_total', 'avg_distance', 'avg_duration_min')))} FROM hm GROUP BY 1, 2, 3)"


def gaps(src: str, fractional: bool = False, name: str = "gd", zones: bool = True) -> str:
    lag = "lag(pickup_ts) OVER (PARTITION BY pickup_date, pu_location_id ORDER BY pickup_ts)"
    gap = f"date_diff('second', {lag}, pickup_ts)::DOUBLE / 60.0::DOUBLE" if fractional else f"date_diff('minute', {lag}, pickup_ts)"
    z = "max(pu_borough) AS pu_borough, max(pu_zone) AS pu_zone, " if zones else ""
    return f"""{name} AS (SELECT pickup_date, pu_location_id, {z}count(*) AS trip_count, max(gap_min) AS longest_gap_min, {mean("gap_min", 6)} AS avg_gap_min, (count(*) FILTER (WHERE gap_min > 60))::BIGINT AS gaps_gt_1h,
  (count(*) FILTER (WHERE gap_min > 180))::BIGINT AS gaps_gt_3h, min(pickup_ts) AS first_pickup_ts, max(pickup_ts) AS last_pickup_ts FROM (SELECT *, {gap} AS gap_min FROM {src}) GROUP BY pickup_date, pu_location_id)"""


GY = f"""gy AS (SELECT year(pickup_date)::INT AS pickup_year, pu_location_id, max(pu_borough) AS pu_borough, max(pu_zone) AS pu_zone, sum(trip_count)::BIGINT AS total_trips, count(DISTINCT pickup_date) AS days_with_trips,
  max(longest_gap_min) AS longest_gap_min_year, {mean("longest_gap_min", 6)} AS avg_longest_gap_per_day, count(*) FILTER (WHERE gaps_gt_1h > 0) AS days_with_gap_over_60min, count(*) FILTER (WHERE gaps_gt_3h > 0) AS days_with_gap_over_3h
  FROM gd GROUP BY 1, 2)"""
TM = f"""tm AS (SELECT pickup_year, pickup_month, pu_location_id, {BUCKET} AS distance_bucket, payment_type, max(pu_borough) AS pu_borough, max(pu_zone) AS pu_zone, count(*) AS trip_count, {money("fare_amount")} AS total_fare_amount,
  {money("tip_amount")} AS total_tip_amount, {mean("fare_amount")} AS avg_fare, {mean("tip_amount")} AS avg_tip, {mean("(CASE WHEN payment_type = 1 THEN tip_pct END)", 9)} AS avg_tip_pct_credit,
  quantile_disc(CASE WHEN payment_type = 1 THEN tip_pct END, 0.5) AS p50_tip_pct_credit, quantile_disc(CASE WHEN payment_type = 1 THEN tip_pct END, 0.9) AS p90_tip_pct_credit FROM fact GROUP BY 1, 2, 3, 4, 5)"""
TY = f"""ty AS (SELECT pickup_year, pu_location_id, distance_bucket, payment_type, max(pu_borough) AS pu_borough, max(pu_zone) AS pu_zone, sum(trip_count)::BIGINT AS trip_count, {money("total_fare_amount")} AS total_fare_amount,
  {money("total_tip_amount")} AS total_tip_amount, {money("total_fare_amount")} / nullif(sum(trip_count), 0)::DOUBLE AS avg_fare, {money("total_tip_amount")} / nullif(sum(trip_count), 0)::DOUBLE AS avg_tip, {weighted("avg_tip_pct_credit")}
  FROM tm GROUP BY 1, 2, 3, 4)"""
FACT = "WITH fact AS (SELECT * FROM int_trips_enriched)"
LIVE = "fact AS (SELECT * FROM int_trips_enriched)"
QUARANTINE = STAGED + f""",
q AS (SELECT st.*, md5(concat_ws('-', coalesce(vendor_id::VARCHAR, '_null_'), coalesce(strftime(pickup_ts, '%Y-%m-%d %H:%M:%S'), '_null_'), coalesce(strftime(dropoff_ts, '%Y-%m-%d %H:%M:%S'), '_null_'), coalesce(pu_location_id::VARCHAR, '_null_'),
  coalesce(do_location_id::VARCHAR, '_null_'), coalesce(fare_amount::DECIMAL(18,4)::VARCHAR, '_null_'), coalesce(total_amount::DECIMAL(18,4)::VARCHAR, '_null_'), coalesce(source_filename, '_null_'))) AS quarantine_key
  FROM st WHERE invalid_reason IS NOT NULL)"""
SCD2 = f"""
WITH a AS ({snap("_ingest_batch_id < 'b2025'")}), b AS ({snap()}),
m AS (SELECT a.trip_bk, ({" OR ".join(f"a.{c.strip()} IS DISTINCT FROM b.{c.strip()}" for c in CHECKED.split(","))}) AS changed FROM a JOIN b USING (trip_bk)),
v AS (SELECT a.trip_bk, {CHECKED.replace("fare_amount", "a.fare_amount", 1)}, TIMESTAMP '2025-01-01' AS valid_from, CASE WHEN changed THEN TIMESTAMP '2026-06-01' END AS valid_to FROM a JOIN m USING (trip_bk)
  UNION ALL SELECT b.trip_bk, {CHECKED}, TIMESTAMP '2026-06-01', NULL FROM b LEFT JOIN m USING (trip_bk) WHERE coalesce(changed, true))"""
DAGG = f"""da AS (SELECT pickup_date, pickup_hour, pu_location_id, payment_type, count(*) AS trip_count, {money("total_amount")} AS gross_revenue, {money("fare_amount")} AS total_fare, {money("tip_amount")} AS total_tip,
  {money("trip_distance")} AS total_distance_mi, sum(round(trip_duration_min * 60)::BIGINT)::BIGINT AS total_duration_sec, count(DISTINCT vendor_id) AS distinct_vendors FROM h GROUP BY 1, 2, 3, 4)"""
TDAY = f"""td AS (SELECT pickup_date, pu_location_id, {BUCKET} AS distance_bucket, payment_type, count(*) AS trip_count, {money("fare_amount")} AS total_fare, {money("tip_amount")} AS total_tip, {money("trip_distance")} AS total_distance_mi FROM h GROUP BY 1, 2, 3, 4)"""

SQL = {
    "zone_revenue_monthly": f"{FACT}, {ZM} SELECT * FROM zm",
    "zone_revenue_yearly": f"{FACT}, {ZM}, {ZY} SELECT * FROM zy",
    "zone_revenue_rank_shift": f"""{FACT}, {ZM}, {ZY}, x AS (SELECT zm.*, lag(revenue_rank_in_month) OVER (PARTITION BY pu_location_id ORDER BY pickup_year, pickup_month) AS p FROM zm WHERE pickup_year = {REVENUE_YEAR})
SELECT x.pickup_year, x.pickup_month, x.pu_location_id, x.pu_borough, x.pu_zone, x.trip_count, {rnd("x.gross_revenue", 2)} AS gross_revenue_usd, revenue_rank_in_month, p AS prev_month_rank, coalesce(p - revenue_rank_in_month, 0)::BIGINT AS rank_change_vs_prev_month,
{rnd("yearly_gross_revenue", 2)} AS yearly_gross_revenue_usd, yearly_revenue_rank FROM x JOIN zy ON zy.pickup_year = x.pickup_year AND zy.pu_location_id = x.pu_location_id WHERE revenue_rank_in_month <= 20""",
    "hourly_demand_monthly": f"{FACT}, {HM} SELECT * FROM hm",
    "hourly_demand_yearly": f"{FACT}, {HM}, {HY} SELECT * FROM hy",
    "hourly_peak_trough": f"""{FACT}, {HM}, {HY} SELECT pickup_dow, pickup_hour, trip_count, {rnd("avg_fare", 2, 6)} AS avg_fare_usd, {rnd("avg_total", 2, 6)} AS avg_total_usd, {rnd("avg_distance", 2, 6)} AS avg_distance_mi,
{rnd("avg_duration_min", 1, 6)} AS avg_duration_min, CASE WHEN trip_count = max(trip_count) OVER (PARTITION BY pickup_dow) THEN 'peak' WHEN trip_count = min(trip_count) OVER (PARTITION BY pickup_dow) THEN 'trough' END AS dow_extreme,
rank() OVER (PARTITION BY pickup_dow ORDER BY trip_count DESC) AS dow_trip_rank FROM hy WHERE pickup_year = {YEAR}""",
    "supply_gaps_daily": f"{FACT}, {gaps('fact')} SELECT * FROM gd",
    "supply_gaps_fractional": f"{FACT}, {gaps('fact', True, zones=False)} SELECT * FROM gd",
    "supply_gaps_yearly": f"{FACT}, {gaps('fact')}, {GY} SELECT * FROM gy",
    "underserved_zones": f"""{FACT}, {gaps('fact')}, {GY}, w AS (SELECT * FROM gd WHERE year(pickup_date) = {YEAR} QUALIFY row_number() OVER (PARTITION BY pu_location_id ORDER BY longest_gap_min DESC NULLS LAST, pickup_date) = 1)
SELECT gy.pu_borough, gy.pu_zone, gy.pu_location_id, days_with_trips, total_trips, {rnd("avg_longest_gap_per_day", 1, 6)} AS avg_daily_longest_gap_min, longest_gap_min_year AS worst_observed_gap_min, days_with_gap_over_60min, days_with_gap_over_3h,
w.pickup_date AS worst_day, w.longest_gap_min AS worst_day_longest_gap_min, w.trip_count AS worst_day_trip_count, rank() OVER (ORDER BY days_with_gap_over_3h DESC, avg_longest_gap_per_day DESC NULLS LAST) AS underserved_rank
FROM gy LEFT JOIN w ON w.pu_location_id = gy.pu_location_id WHERE gy.pickup_year = {YEAR} AND days_with_trips >= 30 AND total_trips >= 100 ORDER BY underserved_rank, gy.pu_location_id LIMIT 50""",
    "tip_behaviour_monthly": f"{FACT}, {TM} SELECT * FROM tm",
    "tip_behaviour_yearly": f"{FACT}, {TM}, {TY} SELECT * FROM ty",
    "tip_vs_city": f"""{FACT}, {TM}, {TY}, x AS (SELECT *, sum(avg_tip_pct_credit::DECIMAL(18,12)) OVER (PARTITION BY distance_bucket)::DOUBLE / (count(avg_tip_pct_credit) OVER (PARTITION BY distance_bucket))::DOUBLE AS city
  FROM ty WHERE pickup_year = {YEAR} AND payment_type = 1 AND trip_count >= 20)
SELECT pu_location_id, pu_borough, pu_zone, distance_bucket, trip_count, {rnd("(avg_tip_pct_credit * 100)", 2)} AS avg_tip_pct, {rnd("(city * 100)", 2)} AS city_avg_tip_pct, {rnd("((avg_tip_pct_credit - city) * 100)", 2)} AS tip_pct_deviation_pp, {rnd("avg_tip", 2, 6)} AS avg_tip_usd FROM x""",
    "dedupe_natural_key": f"SELECT trip_bk, _row_id, _ingest_batch_id, fare_amount, payment_type FROM ({snap()})",
    "dedupe_by_file": f"SELECT _row_id, _source_filename, fare_amount, payment_type FROM ({BY_FILE})",
    "surrogate_key": f"SELECT _row_id, {BK} AS trip_bk FROM yellow_tripdata",
    "classify_rows": f"{STAGED} SELECT trip_bk, pickup_year, pickup_month, pickup_dow, invalid_reason, invalid_reason IS NULL AS is_valid FROM st",
    "classify_repeats": f"WITH{staged('SELECT NULL AS trip_bk, * FROM yellow_tripdata')} SELECT invalid_reason, count(*) AS n FROM st GROUP BY 1",
    "fact_trips": f"""{STAGED} SELECT trip_bk, pickup_ts, pickup_dow, round(trip_duration_min * 60)::BIGINT AS duration_sec, total_amount, p.zone_name AS pu_zone, o.zone_name AS do_zone, p.borough AS pu_borough, o.service_zone AS do_service_zone
FROM st LEFT JOIN dim_zones p ON p.location_id = pu_location_id LEFT JOIN dim_zones o ON o.location_id = do_location_id WHERE invalid_reason IS NULL""",
    "quarantine_rows": f"{QUARANTINE} SELECT quarantine_key, invalid_reason, pickup_year, p.zone_name AS pu_zone, o.zone_name AS do_zone FROM q LEFT JOIN dim_zones p ON p.location_id = pu_location_id LEFT JOIN dim_zones o ON o.location_id = do_location_id",
    "quarantine_share": f"{QUARANTINE} SELECT invalid_reason, count(*) AS rows_quarantined, {rnd('(100.0::DOUBLE * count(*) / sum(count(*)) OVER ())', 3)} AS pct_of_quarantined FROM q GROUP BY 1",
    "quarantine_coverage": f"{QUARANTINE} SELECT pickup_year, pickup_month, count(*) AS quarantined_trip_count, min(pickup_date) AS first_pickup_date, max(pickup_date) AS last_pickup_date FROM q WHERE pickup_year IS NOT NULL GROUP BY 1, 2",
    "month_scope_with_undated": f"{QUARANTINE} SELECT pickup_year, invalid_reason, count(*) AS n FROM q WHERE pickup_year IS NULL OR (pickup_year = {YEAR} AND pickup_month = 3) GROUP BY 1, 2",
    "enrich_role_playing": """SELECT trip_bk, t.pu_location_id, t.do_location_id, p.borough AS pu_borough, p.zone_name AS pu_zone, p.service_zone AS pu_service_zone, o.borough AS do_borough, o.zone_name AS do_zone, o.service_zone AS do_service_zone
FROM int_trips_enriched t LEFT JOIN dim_zones p ON p.location_id = t.pu_location_id LEFT JOIN dim_zones o ON o.location_id = t.do_location_id""",
    "daily_agg_historical": f"WITH{HIST}, {DAGG} SELECT * FROM da",
    "daily_agg_of_a_year": f"WITH{HIST_YEAR}, {DAGG} SELECT * FROM da",
    "lake_history": f"WITH{HIST}, {DAGG} SELECT * FROM da",
    "tip_behaviour_historical": f"WITH{HIST}, {TDAY} SELECT * FROM td",
    "supply_gaps_historical": f"WITH{HIST}, {gaps('h', True, zones=False)} SELECT * FROM gd",
    "union_priority_q1": f"""WITH {LIVE}, {ZM},{HIST}, {DAGG},
u AS (SELECT 'live' AS source, 0 AS o, pickup_year, pickup_month, pu_location_id, trip_count, gross_revenue FROM zm UNION ALL
  SELECT 'historical', 1, year(pickup_date)::INT, month(pickup_date)::INT, pu_location_id, sum(trip_count)::BIGINT, {money("gross_revenue")} FROM da GROUP BY 3, 4, 5),
x AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY pickup_year, pickup_month, pu_location_id ORDER BY o) = 1)
SELECT pickup_year, pickup_month, pu_location_id, trip_count, {rnd("gross_revenue", 0)} AS revenue_usd, rank() OVER (PARTITION BY pickup_year, pickup_month ORDER BY gross_revenue DESC NULLS LAST) AS revenue_rank_in_month, source FROM x QUALIFY revenue_rank_in_month <= 20""",
    "union_priority_q2": f"""WITH {LIVE}, {HM},{HIST}, {DAGG},
u AS (SELECT 0 AS o, pickup_year, pickup_month, pickup_dow, pickup_hour, trip_count, avg_fare * trip_count AS fare FROM hm UNION ALL
  SELECT 1, year(pickup_date)::INT, month(pickup_date)::INT, isodow(pickup_date)::INT, pickup_hour, sum(trip_count)::BIGINT, {money("total_fare")} FROM da GROUP BY 2, 3, 4, 5),
x AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY pickup_year, pickup_month, pickup_dow, pickup_hour ORDER BY o) = 1)
SELECT pickup_year, pickup_dow, pickup_hour, sum(trip_count)::BIGINT AS trip_count, {rnd("(sum(fare::DECIMAL(18,6))::DOUBLE / nullif(sum(trip_count), 0)::DOUBLE)", 2, 6)} AS avg_fare_usd FROM x GROUP BY 1, 2, 3""",
    "union_priority_q3": f"""WITH {LIVE}, {gaps("fact")},{HIST}, {gaps("h", True, "gh", False)},
u AS (SELECT 0 AS o, pickup_date, pu_location_id, trip_count, longest_gap_min::DOUBLE AS longest_gap_min, gaps_gt_1h, gaps_gt_3h FROM gd UNION ALL SELECT 1, pickup_date, pu_location_id, trip_count, longest_gap_min, gaps_gt_1h, gaps_gt_3h FROM gh),
x AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY pickup_date, pu_location_id ORDER BY o) = 1),
g AS (SELECT year(pickup_date)::INT AS pickup_year, pu_location_id, count(DISTINCT pickup_date) AS days_with_trips, sum(trip_count)::BIGINT AS total_trips, {rnd("max(longest_gap_min)", 0, 6)} AS longest_gap_min_year, {mean("longest_gap_min", 6)} AS a,
  count(*) FILTER (WHERE gaps_gt_1h > 0) AS days_with_gap_over_60min, count(*) FILTER (WHERE gaps_gt_3h > 0) AS days_with_gap_over_3h FROM x WHERE pu_location_id IS NOT NULL GROUP BY 1, 2)
SELECT pickup_year, pu_location_id, days_with_trips, total_trips, longest_gap_min_year, {rnd("a", 1, 6)} AS avg_longest_gap_per_day, days_with_gap_over_60min, days_with_gap_over_3h,
rank() OVER (PARTITION BY pickup_year ORDER BY days_with_gap_over_3h DESC, a DESC NULLS LAST) AS underserved_rank FROM g WHERE days_with_trips >= 30 AND total_trips >= 100 QUALIFY underserved_rank <= 20""",
    "union_priority_q4": f"""WITH {LIVE}, {TM},{HIST}, {TDAY},
u AS (SELECT 0 AS o, pickup_year, pickup_month, pu_location_id, distance_bucket, payment_type, trip_count, total_fare_amount AS f, total_tip_amount AS t FROM tm UNION ALL
  SELECT 1, year(pickup_date)::INT, month(pickup_date)::INT, pu_location_id, distance_bucket, payment_type, sum(trip_count)::BIGINT, {money("total_fare")}, {money("total_tip")} FROM td GROUP BY 2, 3, 4, 5, 6),
x AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY pickup_year, pickup_month, pu_location_id, distance_bucket, payment_type ORDER BY o) = 1)
SELECT pickup_year, pu_location_id, distance_bucket, payment_type, sum(trip_count)::BIGINT AS trip_count, {rnd(f"({money('t')} / nullif({money('f')}, 0) * 100)", 2)} AS avg_tip_pct, {rnd(f"({money('t')} / nullif(sum(trip_count), 0)::DOUBLE)", 2)} AS avg_tip_usd
FROM x WHERE payment_type = 1 GROUP BY 1, 2, 3, 4 HAVING sum(trip_count) >= 20""",
    "scd2_versions": f"{SCD2} SELECT trip_bk, fare_amount, payment_type, valid_from, valid_to FROM v",
    "scd2_current": f"{SCD2} SELECT trip_bk, fare_amount, tip_amount, valid_from FROM v WHERE valid_to IS NULL",
    "scd2_health": f"{SCD2} SELECT count(DISTINCT trip_bk) AS unique_keys, count(*) AS total_rows, count(*) FILTER (WHERE valid_to IS NULL) AS current_versions, count(DISTINCT CASE WHEN valid_to IS NOT NULL THEN trip_bk END) AS keys_with_closed_versions FROM v",
    "merge_upsert": f"""WITH o AS ({snap("_ingest_batch_id < 'b2025'")}), n AS ({snap("_ingest_batch_id >= 'b2025'")})
SELECT trip_bk, fare_amount, total_amount, _ingest_batch_id FROM n UNION ALL SELECT trip_bk, fare_amount, total_amount, _ingest_batch_id FROM o WHERE trip_bk NOT IN (SELECT trip_bk FROM n)""",
    "delete_insert_scope": f"""WITH o AS (SELECT pickup_year, pickup_month, pu_location_id, count(*) AS trip_count FROM int_trips_enriched WHERE loaded_at < TIMESTAMPTZ '2025-06-01 00:00:00+00' GROUP BY 1, 2, 3),
n AS (SELECT pickup_year, pickup_month, pu_location_id, count(*) AS trip_count FROM int_trips_enriched WHERE pickup_year = {YEAR} GROUP BY 1, 2, 3)
SELECT * FROM n UNION ALL SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.pickup_year = o.pickup_year AND n.pickup_month = o.pickup_month AND n.pu_location_id = o.pu_location_id)""",
    "replace_scope": f"""SELECT pickup_year, pickup_month, pu_location_id, count(*) AS trip_count FROM int_trips_enriched WHERE pickup_year = {YEAR} OR loaded_at < TIMESTAMPTZ '2025-06-01 00:00:00+00' GROUP BY 1, 2, 3""",
    "partition_replace": "SELECT _ingest_batch_id, count(*) AS n FROM yellow_tripdata WHERE lower(trim(regexp_extract(_source_filename, '([^/]*)$', 1))) <> 'yellow_tripdata_2025-05_s0007.parquet' GROUP BY 1",
    "bronze_load_audit": "SELECT _loaded_by, count(*) AS rows_loaded, count(DISTINCT _ingest_batch_id) AS distinct_load_events, min(_loaded_at) AS first_load, max(_loaded_at) AS last_load FROM yellow_tripdata GROUP BY 1",
    "coverage_by_month": f"SELECT pickup_year, pickup_month, count(*) AS valid_trip_count, {rnd(money('total_amount'), 0)} AS gross_revenue_usd, min(pickup_date) AS first_pickup_date, max(pickup_date) AS last_pickup_date FROM int_trips_enriched GROUP BY 1, 2",
    "top_zones": f"""SELECT pu_borough, pu_zone, count(*) AS trips, {rnd(money("total_amount"), 0)} AS gross_revenue_usd, {rnd(mean("total_amount"), 2)} AS avg_fare_usd, {rnd("(" + mean("tip_pct", 9) + " * 100)", 1)} AS avg_tip_pct
FROM int_trips_enriched GROUP BY 1, 2 ORDER BY {money("total_amount")} DESC NULLS LAST, 1 NULLS FIRST, 2 NULLS FIRST LIMIT 10""",
    "month_over_month_anomalies": """WITH m AS (SELECT pickup_year, pickup_month, count(*) AS trip_count FROM int_trips_enriched GROUP BY 1, 2), p AS (SELECT *, lag(trip_count) OVER (ORDER BY pickup_year NULLS FIRST, pickup_month NULLS FIRST) AS prev_trip_count FROM m)
SELECT *, abs(trip_count - prev_trip_count)::DOUBLE / nullif(prev_trip_count, 0)::DOUBLE AS pct_change FROM p WHERE trip_count >= 100 AND prev_trip_count >= 100 AND abs(trip_count - prev_trip_count)::DOUBLE / prev_trip_count::DOUBLE > 0.05""",
    "fact_mart_reconciliation": """WITH f AS (SELECT pickup_year, pickup_month, count(*) AS fact_count, count(*) FILTER (WHERE loaded_at < TIMESTAMPTZ '2025-06-01 00:00:00+00') AS mart_count FROM int_trips_enriched GROUP BY 1, 2)
SELECT 'zone_revenue_monthly' AS mart, pickup_year, pickup_month, fact_count, mart_count, fact_count - mart_count AS diff FROM f WHERE fact_count <> mart_count""",
    "pending_rebuilds": """WITH f AS (SELECT pickup_year, pickup_month, count(*) AS fact_count, count(*) FILTER (WHERE loaded_at < TIMESTAMPTZ '2025-06-01 00:00:00+00') AS mart_count FROM int_trips_enriched GROUP BY 1, 2)
SELECT mart, pickup_year, pickup_month, fact_count, mart_count, fact_count - mart_count AS diff FROM f, (VALUES ('agg_hourly_demand_monthly'), ('agg_zone_revenue_monthly'), ('agg_zone_tip_behaviour_monthly'), ('agg_zone_supply_gaps_daily')) m(mart) WHERE fact_count <> mart_count""",
    "read_raw_files": """SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, RatecodeID, store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
improvement_surcharge, total_amount, congestion_surcharge, airport_fee, CASE WHEN coalesce(PULocationID % 2, 0) <> 1 THEN cbd_congestion_fee END AS cbd_congestion_fee FROM yellow_tripdata""",
    "lake_versions": f"{SCD2} SELECT trip_bk, fare_amount, payment_type, valid_from, valid_to FROM v",
    "lake_marts": f"""{STAGED}, fact AS (SELECT st.*, p.borough AS pu_borough, p.zone_name AS pu_zone FROM st LEFT JOIN dim_zones p ON p.location_id = pu_location_id WHERE invalid_reason IS NULL), {gaps('fact')}, {GY}
SELECT 'revenue' AS mart, pickup_year, pu_location_id, count(*) AS n, {money("total_amount")} AS amount FROM fact GROUP BY 2, 3
UNION ALL SELECT 'tips', pickup_year, pu_location_id, count(*), {money("tip_amount")} FROM fact GROUP BY 2, 3 UNION ALL SELECT 'gaps', pickup_year, pu_location_id, total_trips, longest_gap_min_year::DOUBLE FROM gy""",
    "lake_pending": "SELECT NULL::VARCHAR AS mart, NULL::INT AS pickup_year, NULL::INT AS pickup_month, NULL::BIGINT AS fact_count, NULL::BIGINT AS mart_count, NULL::BIGINT AS diff WHERE false",
    "lake_fingerprints": """WITH f AS (SELECT snapshot_id s, lower(trim(regexp_extract(filename, '([^/]*)$', 1))) n, lower(trim(replace(regexp_replace(trim(etag), '^[wW]/', ''), '"', ''))) e, recorded_at r FROM source_fingerprints WHERE filename IS NOT NULL AND snapshot_id IS NOT NULL)
SELECT n AS filename, s AS snapshot_id, e AS etag FROM f QUALIFY row_number() OVER (PARTITION BY n ORDER BY s DESC, r DESC NULLS LAST, e DESC NULLS LAST) = 1""",
    "dq_not_null": "SELECT _row_id FROM yellow_tripdata WHERE _loaded_at IS NULL",
    "dq_duplicate_keys": f"SELECT {BK} AS trip_bk, count(*) AS n FROM yellow_tripdata GROUP BY 1 HAVING count(*) > 1",
    "dq_unique_combination": "SELECT _source_filename, tpep_pickup_datetime, PULocationID, count(*) AS n FROM yellow_tripdata WHERE _source_filename IS NOT NULL AND tpep_pickup_datetime IS NOT NULL AND PULocationID IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) > 1",
    "dq_accepted_values": "SELECT _row_id, payment_type FROM yellow_tripdata WHERE payment_type NOT IN (1, 2, 3, 4, 5, 6)",
    "dq_orphans": "SELECT _row_id, PULocationID FROM yellow_tripdata WHERE PULocationID IS NOT NULL AND PULocationID NOT IN (SELECT location_id FROM dim_zones WHERE location_id IS NOT NULL)",
    "dq_out_of_range": "SELECT _row_id, fare_amount FROM yellow_tripdata WHERE payment_type = 1 AND (fare_amount < 0 OR fare_amount > 1000)",
    "dq_duration_sane": f"{STAGED} SELECT trip_bk FROM st WHERE payment_type IS NOT NULL AND (trip_duration_min IS NULL OR trip_duration_min <= 0 OR trip_duration_min > 720)",
    "dq_one_current": "SELECT trip_bk, count(*) AS n FROM snp_yellow_trips WHERE dbt_valid_to IS NULL AND trip_bk IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "source_freshness": """SELECT m AS last_loaded, date_diff('day', m::DATE, DATE '2026-02-15')::INT AS age_days, CASE WHEN m IS NULL OR date_diff('day', m::DATE, DATE '2026-02-15') > 75 THEN 'error' WHEN date_diff('day', m::DATE, DATE '2026-02-15') > 45 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max(_loaded_at) AT TIME ZONE 'UTC' AS m FROM yellow_tripdata)""",
    "fingerprint_state": """WITH f AS (SELECT snapshot_id s, lower(trim(regexp_extract(filename, '([^/]*)$', 1))) n, lower(trim(replace(regexp_replace(trim(etag), '^[wW]/', ''), '"', ''))) e, recorded_at r FROM source_fingerprints), t AS (SELECT max(s) m FROM f),
o AS (SELECT n, arg_max(e, (s, r, e)) e FROM f, t WHERE s < m GROUP BY n), c AS (SELECT n, arg_max(e, (r, e)) e FROM f, t WHERE s = m GROUP BY n)
SELECT coalesce(c.n, o.n) AS filename, CASE WHEN c.e IS NULL THEN 'not_published' WHEN o.e IS NULL THEN 'new' WHEN c.e = o.e THEN 'unchanged' ELSE 'drifted' END AS status FROM c FULL JOIN o ON c.n = o.n""",
}
SQL["lake_facts"], SQL["lake_quarantine"] = SQL["fact_trips"], SQL["quarantine_share"]
