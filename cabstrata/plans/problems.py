"""Queries of the general training-data operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstrata.functions.keys import trip_key
from cabstrata.operators import drift, history, profile, skew, snapshots
from cabstrata.session import load

HEAVY_SHARE = 0.03
ACCEPTED = {"passenger_count": profile.Domain(("9",), 0, 9), "RatecodeID": profile.Domain(("9",), 1, 6), "payment_type": profile.Domain(("9",), 1, 6)}


def _money(c: str):
    return F.col(c).cast("decimal(18,4)")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    trips, zones = load(spark, d, "int_trips_enriched"), load(spark, d, "dim_zones").withColumnRenamed("location_id", "pu_location_id")
    states = skew.eager_join_aggregate(trips, zones, ["pu_location_id"], ["pu_location_id"], how="left", count="trips")
    return skew.heavy_keys(states, "pu_location_id", "trips", HEAVY_SHARE)


def p1_zone_totals(spark: SparkSession, d: str) -> DataFrame:
    trips, zones = load(spark, d, "int_trips_enriched"), load(spark, d, "dim_zones").withColumnRenamed("location_id", "pu_location_id")
    sums = {"total_amount": _money("total_amount"), "fare_amount": _money("fare_amount"), "tip_amount": _money("tip_amount")}
    out = skew.eager_join_aggregate(trips, zones, ["pu_location_id"], ["pu_location_id", "borough", "zone_name"], right_by=["borough", "zone_name"], left_sums=sums, how="left", count="trips")
    return out.select("pu_location_id", "borough", "zone_name", "trips", *[F.col(c).cast("decimal(38,4)").alias(c) for c in sums])


def p1_zone_flow(spark: SparkSession, d: str) -> DataFrame:
    """Per zone: the pairs of a trip that ended and a trip that began there on one day, and the money of
    both sides over all pairs; the pairs themselves are never formed."""
    trips = load(spark, d, "int_trips_enriched")
    began = trips.select(F.col("pu_location_id").alias("zone"), F.col("pickup_date").alias("day"), "total_amount")
    ended = trips.select(F.col("do_location_id").alias("zone"), F.to_date("dropoff_ts").alias("day"), F.col("total_amount").alias("ended_amount"))
    out = skew.eager_join_aggregate(began, ended, ["zone", "day"], ["zone"], left_sums={"began_amount": _money("total_amount")}, right_sums={"ended_amount": _money("ended_amount")}, count="pairs")
    return out.select("zone", "pairs", F.col("began_amount").cast("decimal(38,4)").alias("began_amount"), F.col("ended_amount").cast("decimal(38,4)").alias("ended_amount"))


def _load_profile(spark: SparkSession, d: str) -> DataFrame:
    counts = profile.value_counts(load(spark, d, "yellow_tripdata"), "_ingest_batch_id", "_loaded_by", list(ACCEPTED))
    return profile.profile_from_counts(counts, ACCEPTED)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return profile.load_issues(_load_profile(spark, d))


def p4_load_profile(spark: SparkSession, d: str) -> DataFrame:
    p = _load_profile(spark, d)
    counts = ["n_rows", "n_null", "n_distinct", "n_other_mask", "n_outside"]
    return p.select("batch_id", "column_name", *counts, F.round("mask_divergence", 6).alias("mask_divergence"), F.round("value_divergence", 6).alias("value_divergence"))


def _mask_counts(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "yellow_tripdata")
    return profile.mask_counts(t, "_ingest_batch_id", "_loaded_by", t.columns)


def p4_mask_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.mask_profile(_mask_counts(spark, d)).withColumn("mask_divergence", F.round("mask_divergence", 6))


def p4_patterns(spark: SparkSession, d: str) -> DataFrame:
    """The patterns of every column: its masks with more than 3 % of the non-null rows."""
    return profile.column_patterns(_mask_counts(spark, d)).where("not rare").select("column_name", "mask", "n_rows", F.round("share", 6).alias("share"), "place")


def p4_ranges(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "yellow_tripdata")
    return profile.range_profile(t, "_ingest_batch_id", t.columns)


def p4_distinct(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "yellow_tripdata")
    return profile.distinct_profile(t, "_ingest_batch_id", t.columns)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.file_changes(load(spark, d, "source_fingerprints")).unionByName(snapshots.delivery_changes(load(spark, d, "yellow_tripdata")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    h = history.combined_history(load(spark, d, "snp_yellow_trips"), "trip_bk", "dbt_valid_from", ["fare_amount", "tip_amount"], [F.col("_loaded_at")])
    text = "yyyy-MM-dd HH:mm:ss"
    return h.where("versions >= 2").select("trip_bk", F.date_format("valid_from", text).alias("valid_from"), F.coalesce(F.date_format("valid_to", text), F.lit("open")).alias("valid_to"))


def p6_fare_history(spark: SparkSession, d: str) -> DataFrame:
    """The fare's own intervals, single-version trips included."""
    return history.attribute_history(load(spark, d, "snp_yellow_trips"), "trip_bk", "dbt_valid_from", "fare_amount", [F.col("_loaded_at")])


def p6_two_sources(spark: SparkSession, d: str) -> DataFrame:
    """The fare as the snapshot runs read it and the tip as the loads delivered it, each with its own times, as
    one history of a trip."""
    fare = p6_fare_history(spark, d)
    loads = load(spark, d, "yellow_tripdata").select(trip_key().alias("trip_bk"), F.col("_loaded_at").cast("timestamp_ntz").alias("at"), "tip_amount", "_ingest_batch_id", "_row_id")
    tip = history.attribute_history(loads, "trip_bk", "at", "tip_amount", [F.col("_ingest_batch_id"), -F.col("_row_id")])
    return history.combine_histories({"fare_amount": fare, "tip_amount": tip}, "trip_bk")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.schema_changes(load(spark, d, "raw_file_columns"), load(spark, d, "field_catalog"))


def p7_unplaced(spark: SparkSession, d: str) -> DataFrame:
    """Files that the report of changes can't place, as their names say no month."""
    return drift.unplaced_files(load(spark, d, "raw_file_columns"))


#: What is approved after the first reading: a further format of dates, and two new fields.
APPROVED = {"formats": ["MM/dd/yyyy HH:mm:ss"], "types": {"meter_serial": "string", "ehail_share": "double"}, "names": {"meter_serial": "meter_serial", "ehail_share": "ehail_share"}}


def _records(spark: SparkSession, d: str) -> tuple[DataFrame, drift.Schema]:
    schema = drift.Schema.of(load(spark, d, "field_catalog"))
    approved = schema.with_approved(**APPROVED)
    return drift.replay(drift.ingest(load(spark, d, "raw_trip_records"), schema), approved), approved


def p7_records(spark: SparkSession, d: str) -> DataFrame:
    """All raw records as one typed table. Dates in a further format and two unknown fields are first
    rescued, then replayed once they are approved; the other unknown fields stay rescued."""
    return _records(spark, d)[0]


def p7_rescued(spark: SparkSession, d: str) -> DataFrame:
    """What stays in the rescue column of each file after that, and why."""
    return drift.rescued_report(*_records(spark, d))


QUERIES = {f.__name__: f for f in (p1_found, p1_zone_totals, p1_zone_flow, p4_found, p4_load_profile, p4_mask_profile, p4_patterns, p4_ranges, p4_distinct, p5_found, p6_found, p6_fare_history, p6_two_sources, p7_found, p7_unplaced, p7_records, p7_rescued)}

_IDS = "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID"
_VALUES = "passenger_count, trip_distance, RatecodeID, store_and_fwd_flag, payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, airport_fee, cbd_congestion_fee"
_FILLED = " + ".join(f"({c.strip()} IS NOT NULL)::INT" for c in f"{_IDS}, {_VALUES}".split(","))
_BK = "md5(concat_ws('-', coalesce(VendorID::VARCHAR, '_null_'), coalesce(strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S'), '_null_'), coalesce(strftime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S'), '_null_'), coalesce(PULocationID::VARCHAR, '_null_'), coalesce(DOLocationID::VARCHAR, '_null_')))"

_P4 = """
WITH u AS (
  SELECT _ingest_batch_id b, _loaded_by l, 'passenger_count' c, passenger_count::DOUBLE v FROM yellow_tripdata
  UNION ALL SELECT _ingest_batch_id, _loaded_by, 'RatecodeID', RatecodeID::DOUBLE FROM yellow_tripdata
  UNION ALL SELECT _ingest_batch_id, _loaded_by, 'payment_type', payment_type::DOUBLE FROM yellow_tripdata),
loads AS (SELECT b, lag(b) OVER (PARTITION BY l ORDER BY b) pb FROM (SELECT b, max(l) l FROM u WHERE b IS NOT NULL GROUP BY b)),
base AS (SELECT b, c, count(*) n, count(*) - count(v) nn, count(DISTINCT v) nd,
  count(*) FILTER (WHERE v IS NOT NULL AND NOT (v = floor(v) AND v <= (CASE WHEN c = 'passenger_count' THEN 9 ELSE 6 END) AND v >= (CASE WHEN c = 'passenger_count' THEN 0 ELSE 1 END))) bad,
  count(*) FILTER (WHERE v IS NOT NULL AND NOT (v = floor(v) AND v BETWEEN 0 AND 9)) om
  FROM u GROUP BY b, c),
s AS (SELECT b, c, v, count(*) / sum(count(*)) OVER (PARTITION BY b, c) share FROM u WHERE v IS NOT NULL GROUP BY b, c, v),
cur AS (SELECT s.b, c, v, share FROM s JOIN loads USING (b) WHERE pb IS NOT NULL),
old AS (SELECT loads.b, c, v, share FROM s JOIN loads ON loads.pb = s.b),
div AS (SELECT coalesce(cur.b, old.b) b, coalesce(cur.c, old.c) c, sum(abs(coalesce(cur.share, 0) - coalesce(old.share, 0))) / 2 d
  FROM cur FULL JOIN old ON cur.b = old.b AND cur.c = old.c AND cur.v = old.v GROUP BY 1, 2)
"""

_ALL = ["_row_id", *[c.strip() for c in f"{_IDS}, {_VALUES}".split(",")], "_source_filename", "_ingest_batch_id", "_loaded_by", "_loaded_at"]


def _plain(c: str) -> str:
    return "(_loaded_at AT TIME ZONE 'UTC')" if c == "_loaded_at" else c


def _mask(text: str) -> str:
    """Each character by its class, as one replacement after the other."""
    return f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({text}, '[0-9]', '9', 'g'), '[A-Z]', 'A', 'g'), '[a-z]', 'a', 'g'), '[^\\x00-\\x7F]', 'a', 'g')"


def _text(c: str) -> str:
    decimals = {"passenger_count", "trip_distance", "RatecodeID"} | {x for x in _ALL if x.endswith(("amount", "surcharge", "fee")) or x in ("extra", "mta_tax")}
    return f"rtrim(rtrim({c}::VARCHAR, '0'), '.')" if c in decimals else f"{_plain(c)}::VARCHAR"


def _mask_divergence(source: str) -> str:
    """(b, c, md) of a source of (b, c, m); loads gives each load its predecessor."""
    return f"""WITH ms AS (SELECT b, c, m, count(*) / sum(count(*)) OVER (PARTITION BY b, c) s FROM {source} WHERE m IS NOT NULL AND b IS NOT NULL GROUP BY b, c, m),
mn AS (SELECT ms.* FROM ms JOIN loads USING (b) WHERE pb IS NOT NULL), mo AS (SELECT loads.b, c, m, s FROM ms JOIN loads ON loads.pb = ms.b)
SELECT coalesce(mn.b, mo.b) b, coalesce(mn.c, mo.c) c, sum(abs(coalesce(mn.s, 0) - coalesce(mo.s, 0))) / 2 md FROM mn FULL JOIN mo ON mn.b = mo.b AND mn.c = mo.c AND mn.m = mo.m GROUP BY 1, 2"""


_UNPIVOTED = "u AS (" + " UNION ALL ".join(f"SELECT _ingest_batch_id b, _loaded_by l, '{c}' c, {_mask(_text(c))} m FROM yellow_tripdata" for c in _ALL) + ")"

# The catalog's fields with their types, in the order of their names, and the approved ones.
_FIELDS = {
    "DOLocationID": "int64", "PULocationID": "int64", "RatecodeID": "double", "VendorID": "int64", "airport_fee": "double", "cbd_congestion_fee": "double", "congestion_surcharge": "double",
    "extra": "double", "fare_amount": "double", "improvement_surcharge": "double", "mta_tax": "double", "passenger_count": "double", "payment_type": "int64", "store_and_fwd_flag": "string",
    "tip_amount": "double", "tolls_amount": "double", "total_amount": "double", "tpep_dropoff_datetime": "timestamp", "tpep_pickup_datetime": "timestamp", "trip_distance": "double",
    "meter_serial": "string", "ehail_share": "double",
}
_CASTS = {
    "int64": "TRY_CAST(regexp_replace(trim(v), '\\.0*$', '') AS BIGINT)", "double": "TRY_CAST(trim(v) AS DOUBLE)", "string": "v",
    "timestamp": "coalesce(try_strptime(v, '%Y-%m-%dT%H:%M:%S'), try_strptime(v, '%Y-%m-%d %H:%M:%S'), try_strptime(v, '%m/%d/%Y %H:%M:%S'))",
}
_P7 = rf"""
WITH one AS (SELECT filename, row_no, arg_max(coalesce(payload, ''), (coalesce(json_valid(payload), false), coalesce(payload, ''))) p, max(payload) IS NULL AS gone FROM raw_trip_records GROUP BY 1, 2),
e0 AS (SELECT filename, row_no, p, unnest(json_keys(p)) k, generate_subscripts(json_keys(p), 1) i FROM one WHERE NOT gone AND json_valid(p)),
cat AS (SELECT lower(regexp_replace(known_name, '[^\p{{L}}\p{{N}}]', '', 'g')) b, min(field_name) fld FROM field_catalog WHERE known_name IS NOT NULL GROUP BY 1 UNION ALL VALUES ('meterserial', 'meter_serial'), ('ehailshare', 'ehail_share')),
e1 AS (SELECT filename, row_no, k, i, json_extract_string(p, '$."' || k || '"') v, fld FROM e0 LEFT JOIN cat ON b = lower(regexp_replace(k, '[^\p{{L}}\p{{N}}]', '', 'g'))),
e AS (SELECT *, row_number() OVER (PARTITION BY filename, row_no, fld ORDER BY v IS NULL, i) r,
  CASE {" ".join(f"WHEN fld = '{f}' THEN ({_CASTS[k]}) IS NOT NULL" for f, k in _FIELDS.items())} ELSE false END fits FROM e1),
g AS (SELECT filename, row_no, {", ".join(f"max({_CASTS[k]}) FILTER (WHERE fld = '{f}' AND r = 1) AS {f}" for f, k in _FIELDS.items())},
  string_agg('"' || k || '":' || coalesce(to_json(v), 'null'), ',' ORDER BY v IS NULL, i) FILTER (WHERE CASE WHEN v IS NULL THEN fld IS NULL ELSE NOT (fits AND r = 1) END) rest FROM e GROUP BY 1, 2)"""

SQL = {
    "p1_found": "SELECT pu_location_id FROM int_trips_enriched WHERE pu_location_id IS NOT NULL GROUP BY 1 HAVING count(*) > 0.03 * (SELECT count(*) FROM int_trips_enriched)",
    "p1_zone_totals": """SELECT t.pu_location_id, z.borough, z.zone_name, count(*) AS trips, sum(total_amount::DECIMAL(18,4))::DECIMAL(38,4) AS total_amount,
sum(fare_amount::DECIMAL(18,4))::DECIMAL(38,4) AS fare_amount, sum(tip_amount::DECIMAL(18,4))::DECIMAL(38,4) AS tip_amount
FROM int_trips_enriched t LEFT JOIN dim_zones z ON z.location_id = t.pu_location_id GROUP BY 1, 2, 3""",
    "p1_zone_flow": """SELECT b.pu_location_id AS zone, count(*) AS pairs, sum(b.total_amount::DECIMAL(18,4))::DECIMAL(38,4) AS began_amount, sum(e.total_amount::DECIMAL(18,4))::DECIMAL(38,4) AS ended_amount
FROM int_trips_enriched b JOIN int_trips_enriched e ON e.do_location_id = b.pu_location_id AND e.dropoff_ts::DATE = b.pickup_date GROUP BY 1""",
    "p4_found": _P4 + """SELECT b AS batch_id, c AS column_name, 'values' AS issue FROM base WHERE bad > 0.03 * (n - nn)
UNION ALL SELECT x.b, x.c, 'nulls' FROM base x JOIN loads ON loads.b = x.b JOIN base y ON y.b = loads.pb AND y.c = x.c WHERE abs(x.nn / x.n - y.nn / y.n) > 0.15
UNION ALL SELECT b, c, 'shift' FROM div WHERE d > 0.2""",
    "p4_load_profile": _P4 + f"""SELECT base.b AS batch_id, base.c AS column_name, n AS n_rows, nn AS n_null, nd AS n_distinct, om AS n_other_mask, bad - om AS n_outside, round(md, 6) AS mask_divergence, round(d, 6) AS value_divergence
FROM base LEFT JOIN div ON div.b = base.b AND div.c = base.c LEFT JOIN ({_mask_divergence("(SELECT b, c, " + _mask("rtrim(rtrim(v::DECIMAL(18,4)::VARCHAR, '0'), '.')") + " m FROM u)")}) x ON x.b = base.b AND x.c = base.c""",
    "p4_mask_profile": f"""WITH {_UNPIVOTED}, loads AS (SELECT b, lag(b) OVER (PARTITION BY l ORDER BY b) pb FROM (SELECT b, max(l) l FROM u WHERE b IS NOT NULL GROUP BY b)),
mc AS (SELECT c, m, count(*) <= 0.03 * sum(count(*)) OVER (PARTITION BY c) rare FROM u WHERE m IS NOT NULL GROUP BY c, m),
pm AS (SELECT b, c, m, count(*) n FROM u GROUP BY b, c, m), r AS (SELECT pm.*, rare FROM pm LEFT JOIN mc ON mc.c = pm.c AND mc.m = pm.m)
SELECT r.b AS batch_id, r.c AS column_name, sum(n)::BIGINT AS n_rows, coalesce(sum(n) FILTER (WHERE m IS NULL), 0)::BIGINT AS n_null, count(m) AS n_masks, coalesce(sum(n) FILTER (WHERE rare), 0)::BIGINT AS n_rare_mask,
  (list(m ORDER BY n DESC, m) FILTER (WHERE m IS NOT NULL))[1] AS dominant_mask, round(any_value(md), 6) AS mask_divergence
FROM r LEFT JOIN ({_mask_divergence("u")}) x ON x.b = r.b AND x.c = r.c GROUP BY r.b, r.c""",
    "p4_patterns": f"""WITH {_UNPIVOTED}, mc AS (SELECT c, m, count(*) n, sum(count(*)) OVER (PARTITION BY c) t FROM u WHERE m IS NOT NULL GROUP BY c, m)
SELECT c AS column_name, m AS mask, n AS n_rows, round(n / t, 6) AS share, row_number() OVER (PARTITION BY c ORDER BY n DESC, m)::INT AS place FROM mc QUALIFY n > 0.03 * t""",
    "p4_ranges": " UNION ALL ".join(f"SELECT _ingest_batch_id AS batch_id, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, min({_plain(c)})::VARCHAR AS least, max({_plain(c)})::VARCHAR AS greatest FROM yellow_tripdata GROUP BY 1" for c in _ALL),
    "p5_found": f"""
WITH f AS (SELECT DISTINCT snapshot_id s, lower(trim(regexp_extract(filename, '([^/]*)$', 1))) item, lower(trim(replace(regexp_replace(trim(etag), '^[wW]/', ''), '"', ''))) e FROM source_fingerprints WHERE snapshot_id IS NOT NULL AND filename IS NOT NULL),
fs AS (SELECT s, lag(s) OVER (ORDER BY s) p, lead(s) OVER (ORDER BY s) nx FROM (SELECT DISTINCT s FROM f)),
fn AS (SELECT s, item, e FROM f JOIN fs USING (s) WHERE p IS NOT NULL), fo AS (SELECT nx s, item, e FROM f JOIN fs USING (s) WHERE nx IS NOT NULL),
t AS (SELECT lower(trim(regexp_extract(_source_filename, '([^/]*)$', 1))) f, _ingest_batch_id b, {_BK} k, hash({", ".join(f"coalesce({c.strip()}::VARCHAR, '~')" for c in _VALUES.split(","))}) h
  FROM yellow_tripdata WHERE _source_filename IS NOT NULL AND _ingest_batch_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY f, b, k ORDER BY _loaded_at DESC NULLS LAST, {_FILLED} DESC, _row_id) = 1),
ts AS (SELECT f, b, lag(b) OVER (PARTITION BY f ORDER BY b) p, lead(b) OVER (PARTITION BY f ORDER BY b) nx FROM (SELECT DISTINCT f, b FROM t)),
tn AS (SELECT f, b, k, h FROM t JOIN ts USING (f, b) WHERE p IS NOT NULL), tl AS (SELECT f, nx b, k, h FROM t JOIN ts USING (f, b) WHERE nx IS NOT NULL)
SELECT 'file' AS entity, coalesce(fn.item, fo.item) AS item, coalesce(fn.s, fo.s)::VARCHAR AS delivery, CASE WHEN fo.s IS NULL THEN 'added' WHEN fn.s IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM fn FULL JOIN fo ON fn.s = fo.s AND fn.item = fo.item WHERE fo.s IS NULL OR fn.s IS NULL OR fn.e IS DISTINCT FROM fo.e
UNION ALL
SELECT 'trip', coalesce(tn.k, tl.k), coalesce(tn.b, tl.b), CASE WHEN tl.k IS NULL THEN 'added' WHEN tn.k IS NULL THEN 'removed' ELSE 'changed' END
FROM tn FULL JOIN tl ON tn.f = tl.f AND tn.b = tl.b AND tn.k = tl.k WHERE tl.k IS NULL OR tn.k IS NULL OR tn.h <> tl.h""",
    "p6_found": """
WITH r AS (SELECT trip_bk, dbt_valid_from f, fare_amount a, tip_amount t FROM snp_yellow_trips
  QUALIFY row_number() OVER (PARTITION BY trip_bk, dbt_valid_from ORDER BY _loaded_at DESC NULLS LAST, fare_amount DESC NULLS LAST, tip_amount DESC NULLS LAST) = 1),
v AS (SELECT * FROM r WINDOW w AS (PARTITION BY trip_bk ORDER BY f) QUALIFY row_number() OVER w = 1 OR a IS DISTINCT FROM lag(a) OVER w OR t IS DISTINCT FROM lag(t) OVER w),
x AS (SELECT trip_bk, f, lead(f) OVER (PARTITION BY trip_bk ORDER BY f) nx, count(*) OVER (PARTITION BY trip_bk) n FROM v)
SELECT trip_bk, strftime(f, '%Y-%m-%d %H:%M:%S') AS valid_from, coalesce(strftime(nx, '%Y-%m-%d %H:%M:%S'), 'open') AS valid_to FROM x WHERE n >= 2""",
    "p6_fare_history": """
WITH r AS (SELECT trip_bk, dbt_valid_from f, fare_amount a FROM snp_yellow_trips
  QUALIFY row_number() OVER (PARTITION BY trip_bk, dbt_valid_from ORDER BY _loaded_at DESC NULLS LAST, fare_amount DESC NULLS LAST) = 1),
v AS (SELECT * FROM r WINDOW w AS (PARTITION BY trip_bk ORDER BY f) QUALIFY row_number() OVER w = 1 OR a IS DISTINCT FROM lag(a) OVER w)
SELECT trip_bk, 'fare_amount' AS attribute, a AS value, f AS valid_from, lead(f) OVER (PARTITION BY trip_bk ORDER BY f) AS valid_to FROM v""",
    "p6_two_sources": f"""
WITH r AS (SELECT trip_bk, dbt_valid_from f, fare_amount a FROM snp_yellow_trips WHERE trip_bk IS NOT NULL AND dbt_valid_from IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY trip_bk, dbt_valid_from ORDER BY _loaded_at DESC NULLS LAST, fare_amount DESC NULLS LAST) = 1),
q AS (SELECT {_BK} k, (_loaded_at AT TIME ZONE 'UTC') f, tip_amount a, row_number() OVER (PARTITION BY {_BK}, _loaded_at ORDER BY _ingest_batch_id DESC NULLS LAST, _row_id) n FROM yellow_tripdata WHERE _loaded_at IS NOT NULL),
e AS (SELECT trip_bk k, f, a fa, NULL ta, 1 s FROM r UNION ALL SELECT k, f, NULL, a, 2 FROM q WHERE n = 1),
b AS (SELECT DISTINCT k, f FROM e),
v AS (SELECT b.k, b.f, x.fa, y.ta FROM b ASOF LEFT JOIN (SELECT k, f, fa FROM e WHERE s = 1) x ON x.k = b.k AND x.f <= b.f ASOF LEFT JOIN (SELECT k, f, ta FROM e WHERE s = 2) y ON y.k = b.k AND y.f <= b.f),
c AS (SELECT * FROM v WINDOW w AS (PARTITION BY k ORDER BY f) QUALIFY row_number() OVER w = 1 OR fa IS DISTINCT FROM lag(fa) OVER w OR ta IS DISTINCT FROM lag(ta) OVER w)
SELECT k AS trip_bk, fa AS fare_amount, ta AS tip_amount, f AS valid_from, lead(f) OVER (PARTITION BY k ORDER BY f) AS valid_to FROM c""",
    "p7_unplaced": r"SELECT DISTINCT filename FROM raw_file_columns WHERE filename IS NOT NULL AND NOT regexp_matches(filename, '(^|[^0-9])[0-9]{4}-(0[1-9]|1[0-2])([^0-9]|$)')",
    "p7_records": _P7 + f"""SELECT filename, row_no, {", ".join(_FIELDS)}, CASE WHEN gone THEN NULL WHEN NOT json_valid(p) THEN '{{"_broken":' || to_json(p) || '}}' WHEN rest IS NOT NULL THEN '{{' || rest || '}}' END AS _rescued
FROM one LEFT JOIN g USING (filename, row_no)""",
    "p7_rescued": _P7 + """SELECT filename, k AS written_name, CASE WHEN fld IS NULL THEN 'unknown' ELSE 'uncastable' END AS reason, count(*) AS n_records FROM e
WHERE CASE WHEN v IS NULL THEN fld IS NULL ELSE NOT (fits AND r = 1) END GROUP BY 1, 2, 3 UNION ALL SELECT filename, '_broken', 'broken', count(*) FROM one WHERE NOT gone AND NOT json_valid(p) GROUP BY 1""",
    "p7_found": r"""
WITH k AS (SELECT lower(regexp_replace(known_name, '[^\p{L}\p{N}]', '', 'g')) b, min(field_name) fld FROM field_catalog GROUP BY 1),
c AS (SELECT DISTINCT filename, regexp_extract(filename, '_(\d{4}-\d{2})_', 1) m, regexp_replace(filename, '_\d{4}-\d{2}_', '_') ser, coalesce(fld, column_name) fld, column_name cn, data_type dt
  FROM raw_file_columns LEFT JOIN k ON k.b = lower(regexp_replace(column_name, '[^\p{L}\p{N}]', '', 'g'))),
s AS (SELECT ser, m, filename, lag(m) OVER (PARTITION BY ser ORDER BY m) p, lead(filename) OVER (PARTITION BY ser ORDER BY m) nf FROM (SELECT DISTINCT ser, m, filename FROM c)),
n AS (SELECT c.* FROM c JOIN s USING (ser, m, filename) WHERE p IS NOT NULL), o AS (SELECT c.* REPLACE (nf AS filename) FROM c JOIN s USING (ser, m, filename) WHERE nf IS NOT NULL),
j AS (SELECT coalesce(n.filename, o.filename) filename, coalesce(n.fld, o.fld) fld, n.cn ncn, o.cn ocn, n.dt ndt, o.dt odt FROM n FULL JOIN o ON n.filename = o.filename AND n.fld = o.fld)
SELECT filename, fld AS field_name, 'added' AS change FROM j WHERE ocn IS NULL UNION ALL SELECT filename, fld, 'removed' FROM j WHERE ncn IS NULL
UNION ALL SELECT filename, fld, 'renamed' FROM j WHERE ncn <> ocn UNION ALL SELECT filename, fld, 'retyped' FROM j WHERE ndt <> odt""",
}
