"""Queries over stored tables and files: what the pipeline writes, read back. Each makes its own files and lake in
the shared folder."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstrata.functions.keys import bare_etag, bare_name
from cabstrata.functions.scalars import exact_sum
from cabstrata.operators import dq
from cabstrata.plans import consumer, historical, marts, pipeline, trips, twins
from cabstrata.session import load, shared_path
from cabstrata.sources import bronze, files
from cabstrata.sources.months import Month, months_between, parse_months, target_month
from cabstrata.sources.tables import NONE, SEP, Lake
from cabstrata.streaming.files import append_available, hourly_counts, stream_files


def month_parsing(s, d):
    """What the texts of a command line stand for, with the months' file names."""
    rows = [(text, i, str(m), m.filename) for text in ("2023", "2024-02", "2023-11,2024-01,2023-11") for i, m in enumerate(parse_months(text))]
    rows += [("2023-11..2024-02", i, str(m), m.filename) for i, m in enumerate(months_between("2023-11", "2024-02"))]
    return s.createDataFrame(rows, "asked string, place int, month string, filename string")


def run_targets(s, d):
    """The month of a run on 2024-03-05: as asked for, of a backfill's interval, or today's less the lag."""
    today = date(2024, 3, 5)
    cases = {
        "default": target_month(today), "lag 0": target_month(today, lag_months=0), "lag 12": target_month(today, lag_months=12), "asked": target_month(today, 2023, 7),
        "interval": target_month(today, interval_start=date(2023, 5, 1)), "interval too late": target_month(today, interval_start=date(2024, 3, 1)),
    }
    return s.createDataFrame([(k, m.year, m.month) for k, m in cases.items()], "case string, year int, month int")


def write_file(df: DataFrame, path: str) -> None:
    """One Parquet file of that very name, as raw files are published."""
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}.parts")
    fs, p = files._at(df.sparkSession, path)
    (part,) = [x.getPath() for x in fs.listStatus(p.suffix(".parts")) if x.getPath().getName().startswith("part-")]
    fs.delete(p, False)
    fs.rename(part, p)
    fs.delete(p.suffix(".parts"), True)


def _month_rows(s, d, m: Month) -> DataFrame:
    rows = trips._bronze(s, d).where(f"substring(cast(tpep_pickup_datetime as string), 1, 7) = '{m}'")
    return rows.select(*[c for c, _ in bronze.SOURCE])


#: The months whose files are made of the test tables' trips; the third isn't published.
MONTHS = [Month(2024, 5), Month(2024, 6)]
UNPUBLISHED = Month(2024, 7)


def _published_files(s, d) -> tuple[str, str]:
    at = shared_path(s, "files")
    for m in MONTHS:
        write_file(_month_rows(s, d, m), f"{at}/origin/{m.filename}")
    return f"{at}/origin", f"{at}/mirror"


def mirrored_files(s, d):
    """A mirror run three times, the last one by force; what each brought, and whether a month is there."""
    (origin, mirror), three = _published_files(s, d), [*MONTHS, UNPUBLISHED]
    out = [("published", m.filename, files.is_published(s, origin, m)) for m in three]
    for step, force in (("first", False), ("again", False), ("forced", True)):
        new = {p.rsplit("/", 1)[1] for p in files.ingest_missing(s, three, origin, mirror, force)}
        out += [(step, m.filename, m.filename in new) for m in three]
    out += [("mirrored", m.filename, files.exists(s, f"{mirror}/{m.filename}")) for m in three]
    return s.createDataFrame(out, "step string, filename string, yes boolean")


def drift_states(s, d):
    """A file's state before it was ever recorded, after that, after it changed, and of one that isn't there."""
    origin, _ = _published_files(s, d)
    lake, m = Lake(s, shared_path(s, "lake")), MONTHS[0]
    states = [("before", pipeline.detect_drift(lake, origin, m))]
    pipeline.record_fingerprint(lake, origin, m)
    states.append(("recorded", pipeline.detect_drift(lake, origin, m)))
    write_file(_month_rows(s, d, m).limit(1), f"{origin}/{m.filename}")
    states.append(("changed", pipeline.detect_drift(lake, origin, m)))
    states.append(("absent", pipeline.detect_drift(lake, origin, UNPUBLISHED)))
    return s.createDataFrame(states, "moment string, state string")


def raw_provenance(s, d):
    """Rows per file of a load of two files, with the load's columns."""
    origin, _ = _published_files(s, d)
    lake = Lake(s, shared_path(s, "lake"))
    t = pipeline.load_bronze(lake, [f"{origin}/{m.filename}" for m in MONTHS], loaded_by="loader")
    batch = F.length("_ingest_batch_id") == 32
    recent = F.abs(F.timestamp_diff("HOUR", F.col("_loaded_at"), F.current_timestamp())) <= 1
    return t.groupBy("_source_filename").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_ingest_batch_id").alias("batches"), F.min(batch).alias("batch_id"), F.min(F.col("_loaded_by") == "loader").alias("loader"), F.min(recent).alias("now"))


def month_pipeline(s, d):
    """The facts that the runs of two months publish, and the answer for a month that isn't there."""
    origin, mirror = _published_files(s, d)
    lake, zones = Lake(s, shared_path(s, "lake")), load(s, d, "dim_zones")
    for m, at in ((MONTHS[0], "2024-07-01 00:00:00"), (MONTHS[1], "2024-08-01 00:00:00"), (UNPUBLISHED, "2024-09-01 00:00:00")):
        pipeline.run_month(lake, origin, mirror, zones, m, at)
    return lake.read(pipeline.PUBLISHED, "fct_trips").select("trip_bk", "pickup_month", "pu_zone", "do_zone", "source_filename")


def year_job(s, d):
    """The historical days of 2024 from that year's files, the year run twice."""
    at, lake = shared_path(s, "files"), Lake(s, shared_path(s, "lake"))
    for m in parse_months("2024"):
        write_file(_month_rows(s, d, m), f"{at}/{m.filename}")
    for _ in range(2):
        pipeline.run_year(lake, at, 2024)
    return lake.read(pipeline.HISTORICAL, "daily_agg")


def year_job_gaps(s, d):
    at, lake = shared_path(s, "files"), Lake(s, shared_path(s, "lake"))
    for m in parse_months("2024"):
        write_file(_month_rows(s, d, m), f"{at}/{m.filename}")
    pipeline.run_year(lake, at, 2024)
    return lake.read(pipeline.HISTORICAL, "supply_gaps")


def table_operations(s, d):
    """Rows of a table and its copy after each of: write, clone, upsert of the copy, delete and insert, swap, drop."""
    lake, zones = Lake(s, shared_path(s, "lake")), load(s, d, "dim_zones").where("location_id is not null")
    out = []

    def note(step: str) -> None:
        out.extend((step, x, lake.read(x, "zones").count() if lake.exists(x, "zones") else None) for x in ("a", "b"))

    lake.write("a", "zones", zones, by=["location_id % 4"], sort_by=["location_id"])
    note("written")
    lake.clone("a", "b")
    lake.upsert("b", "zones", zones.where("location_id <= 10").unionByName(zones.where("location_id <= 5").withColumn("location_id", F.col("location_id") + 1000)), ["location_id"])
    note("upserted")
    lake.delete_insert("b", "zones", zones.where("location_id = 1").unionByName(zones.where("location_id = 1")), ["location_id"], within=True)
    note("inserted")
    lake.swap("a", "b")
    note("swapped")
    lake.drop("b", ["zones"])
    lake.vacuum()
    note("dropped")
    return s.createDataFrame(out, "step string, schema string, n bigint")


def data_tests(s, d):
    """Severities and offending rows of tests on the raw table; those of single rows are one pass."""
    checks = [
        dq.RowCheck("load time", "t", dq.is_missing("_loaded_at"), "warn"), dq.RowCheck("payment", "t", dq.is_unaccepted("payment_type", [1, 2, 3, 4, 5, 6])), dq.RowCheck("fare", "t", dq.is_outside("fare_amount", 0, 1000)),
        dq.RowCheck("row number", "t", dq.is_missing("_row_id")), dq.Check("unique", lambda x: dq.unique(x["t"], ["_row_id"])), dq.Check("known zones", lambda x: dq.relationships(x["t"], "PULocationID", x["zones"], "location_id"), "warn"),
    ]
    return s.createDataFrame(dq.run_checks(checks, {"t": trips._bronze(s, d), "zones": load(s, d, "dim_zones")}), "name string, severity string, n bigint")


def _as_files(s, d) -> str:
    at = shared_path(s, "stream")
    trips._bronze(s, d).select(*[c for c, _ in bronze.SOURCE]).write.parquet(f"{at}/in")
    return at


def stream_loads(s, d):
    """All raw rows as files through the stream into a table, started twice: the second finds nothing new."""
    at, lake = _as_files(s, d), Lake(s, shared_path(s, "lake"))
    first = append_available(s, lake, "raw", "t", f"{at}/in", f"{at}/checkpoint")
    again = append_available(s, lake, "raw", "t", f"{at}/in", f"{at}/checkpoint")
    return lake.read("raw", "t").where(F.lit(first > 0 and again == 0)).drop("_source_filename", "_ingest_batch_id", "_loaded_by", "_loaded_at")


def stream_hours(s, d):
    """Trips and money per hour and zone, counted by the stream as files come."""
    at, name = _as_files(s, d), f"hours_{uuid.uuid4().hex}"
    q = hourly_counts(stream_files(s, f"{at}/in")).writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", f"{at}/hours").trigger(availableNow=True).start()
    q.awaitTermination()
    return s.table(name).select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "PULocationID", "trip_count", F.col("gross_revenue").cast("decimal(38,4)").alias("gross_revenue"))


def read_raw_files(s, d):
    """All raw rows through two raw files that disagree: one has times as microseconds, other letter cases and
    types, and lacks a column."""
    rows = trips._bronze(s, d).select(*[c for c, _ in bronze.SOURCE])
    odd, at = F.coalesce(F.pmod("PULocationID", F.lit(2)), F.lit(0)) == 1, shared_path(s, "raw-files")
    micros = lambda c: F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(c))
    changed = {"tpep_pickup_datetime": micros("tpep_pickup_datetime"), "tpep_dropoff_datetime": micros("tpep_dropoff_datetime"), "VendorID": F.col("VendorID").cast("bigint"), "payment_type": F.col("payment_type").cast("double")}
    rows.where(odd).withColumns(changed).drop("cbd_congestion_fee").withColumnsRenamed({"trip_distance": "Trip_Distance", "VendorID": "VENDORID"}).write.parquet(f"{at}/a")
    rows.where(~odd).write.parquet(f"{at}/b")
    return bronze.read_all(s, [f"{at}/a", f"{at}/b"]).drop("_source_filename")


def _two_deliveries(s, d, build=False):
    lake = Lake(s, shared_path(s, "lake"))
    rows, zones = trips._bronze(s, d), load(s, d, "dim_zones")
    first = F.coalesce(F.col("_ingest_batch_id") < trips.CUT, F.lit(False))
    for part, at in ((rows.where(first), trips.FIRST_RUN), (rows.where(~first), trips.SECOND_RUN)):
        before = {k: len(v) for k, v in lake.part_directories(pipeline.RAW, "yellow_tripdata").items()}
        pipeline.append_rows(lake, part)
        after = lake.part_directories(pipeline.RAW, "yellow_tripdata")
        months = {k.split(SEP)[1] for k, v in after.items() if len(v) != before.get(k, 0)} | {NONE}
        pipeline.apply_snapshot(lake, at, months)
        if build:
            pipeline.build_marts(lake, zones, months)
            lake.swap(pipeline.PUBLISHED, pipeline.BUILD)
    return lake


def stored_queries(s, d):
    """The consumer queries over a lake in which marts and historical tables of d are stored: name -> DataFrame."""
    lake, p = _two_deliveries(s, d, True), pipeline.PUBLISHED
    for name, df in trips._hist(s, d).items():
        lake.replace(pipeline.HISTORICAL, name, df, (), by=[pipeline.MONTH.format("pickup_date")])
    m = lambda name: lake.read(p, f"agg_{name}")
    return {
        "stored_zone_revenue_rank_shift": lambda: consumer.zone_revenue_rank_shift(m("zone_revenue_monthly"), m("zone_revenue_yearly"), trips.REVENUE_YEAR),
        "stored_hourly_peak_trough": lambda: consumer.hourly_peak_trough(m("hourly_demand_yearly"), trips.YEAR),
        "stored_underserved_zones": lambda: consumer.underserved_zones(m("zone_supply_gaps_daily"), m("zone_supply_gaps_yearly"), trips.YEAR, trips.DAYS, trips.TRIPS),
        "stored_tip_vs_city": lambda: consumer.tip_vs_city(m("zone_tip_behaviour_yearly"), trips.YEAR, trips.TIP_TRIPS),
        "stored_union_priority_q1": lambda: consumer.union_zone_revenue(m("zone_revenue_monthly"), lake.read(pipeline.HISTORICAL, "daily_agg")),
    }


def lake_versions(s, d):
    return _two_deliveries(s, d).read(pipeline.SNAPSHOTS, "trips").select("trip_bk", "fare_amount", "payment_type", "valid_from", "valid_to")


def lake_facts(s, d):
    f = _two_deliveries(s, d, True).read(pipeline.PUBLISHED, "fct_trips")
    return f.select("trip_bk", "pickup_ts", "pickup_dow", F.round(F.col("trip_duration_min") * 60).cast("bigint").alias("duration_sec"), "total_amount", "pu_zone", "do_zone", "pu_borough", "do_service_zone")


def lake_marts(s, d):
    """The published yearly marts side by side: their keys, trips and money."""
    lake = _two_deliveries(s, d, True)
    r, t, g = (lake.read(pipeline.PUBLISHED, f"agg_zone_{m}_yearly") for m in ("revenue", "tip_behaviour", "supply_gaps"))
    parts = (
        r.select(F.lit("revenue").alias("mart"), "pickup_year", "pu_location_id", F.col("trip_count").alias("n"), F.col("yearly_gross_revenue").alias("amount")),
        t.groupBy(F.lit("tips").alias("mart"), "pickup_year", "pu_location_id").agg(F.sum("trip_count").alias("n"), exact_sum(F.col("total_tip_amount")).alias("amount")),
        g.select(F.lit("gaps").alias("mart"), "pickup_year", "pu_location_id", F.col("total_trips").alias("n"), F.col("longest_gap_min_year").cast("double").alias("amount")),
    )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def lake_quarantine(s, d):
    return consumer.quarantine_share(_two_deliveries(s, d, True).read(pipeline.PUBLISHED, "fct_trips_quarantined"))


def lake_pending(s, d):
    """After both deliveries are published nothing is to be built again."""
    return pipeline.pending_rebuilds(_two_deliveries(s, d, True))


def lake_fingerprints(s, d):
    """The table of fingerprints after an upsert of the state before the newest snapshot, and one of that."""
    f = load(s, d, "source_fingerprints").select("snapshot_id", bare_name(F.col("filename")).alias("filename"), bare_etag(F.col("etag")).alias("etag"), "recorded_at").where("filename is not null and snapshot_id is not null")
    newest = f.select(F.max("snapshot_id").alias("m")).scalar()
    lake = Lake(s, shared_path(s, "lake"))
    for part in (f.where(F.col("snapshot_id") < newest), f.where(F.col("snapshot_id") == newest)):
        one = part.groupBy("filename").agg(F.max(F.struct("snapshot_id", "recorded_at", "etag")).alias("s")).select("filename", "s.*")
        lake.upsert(pipeline.RAW, "source_fingerprints", one, ["filename"])
    return lake.read(pipeline.RAW, "source_fingerprints").select("filename", "snapshot_id", "etag")


def lake_history(s, d):
    """The historical table of days after a year was replaced: all loads first, then that year from all loads
    again. A year replaced by the same trips changes nothing."""
    lake, all_days = Lake(s, shared_path(s, "lake")), marts.daily_aggregate(historical.historical_trips(trips._bronze(s, d)))
    lake.replace(pipeline.HISTORICAL, "daily_agg", all_days, (), by=[pipeline.MONTH.format("pickup_date")])
    lake.replace(pipeline.HISTORICAL, "daily_agg", trips.daily_agg_of_a_year(s, d), lambda k: k.startswith(f"{trips.YEAR}-"), strict=True, sync=True)
    return lake.read(pipeline.HISTORICAL, "daily_agg")


QUERIES = {
    f.__name__: f
    for f in (
        month_parsing, run_targets, mirrored_files, drift_states, raw_provenance, read_raw_files, month_pipeline, year_job, year_job_gaps, table_operations, data_tests, stream_loads, stream_hours,
        lake_versions, lake_facts, lake_marts, lake_quarantine, lake_pending, lake_fingerprints, lake_history,
    )
}

_COLUMNS = ", ".join(f"{c}" for c, _ in bronze.SOURCE)
_FILES = "(VALUES ('yellow_tripdata_2024-05.parquet', true), ('yellow_tripdata_2024-06.parquet', true), ('yellow_tripdata_2024-07.parquet', false)) f(filename, there)"
_IN_MONTHS = "strftime(tpep_pickup_datetime, '%Y-%m') IN ('2024-05', '2024-06')"
_NAME = "'yellow_tripdata_' || strftime(tpep_pickup_datetime, '%Y-%m') || '.parquet'"
# Rows of a month's file have no load but the run's: the ladder's later steps alone decide between copies.
_STAGED = twins.staged(f"SELECT {twins.BK} AS trip_bk, * FROM (SELECT * REPLACE ({_NAME} AS _source_filename) FROM yellow_tripdata WHERE {_IN_MONTHS}) QUALIFY row_number() OVER (PARTITION BY {twins.IDS} ORDER BY {twins.LADDER}) = 1")

_YEAR_FILES = twins.staged(f"SELECT 'x' AS trip_bk, * FROM (SELECT * REPLACE ({_NAME} AS _source_filename) FROM yellow_tripdata WHERE year(tpep_pickup_datetime) = 2024) QUALIFY row_number() OVER (PARTITION BY {twins.IDS} ORDER BY {twins.LADDER}) = 1")
_YEAR = f"WITH{_YEAR_FILES}, h AS (SELECT * FROM st WHERE invalid_reason IS NULL)"

SQL = {
    "year_job": f"{_YEAR}, {twins.DAGG} SELECT * FROM da",
    "year_job_gaps": f"{_YEAR}, {twins.gaps('h', True, zones=False)} SELECT * FROM gd",
    "month_parsing": """WITH m AS (SELECT unnest(generate_series(DATE '2023-01-01', DATE '2024-02-01', INTERVAL 1 MONTH))::DATE AS d),
x AS (SELECT '2023' AS asked, row_number() OVER (ORDER BY d) - 1 AS place, d FROM m WHERE year(d) = 2023 UNION ALL SELECT '2024-02', 0, DATE '2024-02-01'
  UNION ALL VALUES ('2023-11,2024-01,2023-11', 0, DATE '2023-11-01'), ('2023-11,2024-01,2023-11', 1, DATE '2024-01-01') UNION ALL SELECT '2023-11..2024-02', row_number() OVER (ORDER BY d) - 1, d FROM m WHERE d >= DATE '2023-11-01')
SELECT asked, place::INT AS place, strftime(d, '%Y-%m') AS month, 'yellow_tripdata_' || strftime(d, '%Y-%m') || '.parquet' AS filename FROM x""",
    "run_targets": """WITH x AS (SELECT DATE '2024-03-05' AS t), y(c, d) AS (SELECT 'default', t - INTERVAL 2 MONTH FROM x UNION ALL SELECT 'lag 0', t FROM x UNION ALL SELECT 'lag 12', t - INTERVAL 12 MONTH FROM x UNION ALL SELECT 'asked', DATE '2023-07-01'
UNION ALL SELECT 'interval', least(DATE '2023-05-01', t - INTERVAL 2 MONTH) FROM x UNION ALL SELECT 'interval too late', least(DATE '2024-03-01', t - INTERVAL 2 MONTH) FROM x) SELECT c AS case, year(d)::INT AS year, month(d)::INT AS month FROM y""",
    "mirrored_files": f"SELECT step, filename, CASE WHEN step = 'again' THEN false ELSE there END AS yes FROM {_FILES}, (VALUES ('published'), ('first'), ('again'), ('forced'), ('mirrored')) s(step)",
    "drift_states": "SELECT * FROM (VALUES ('before', 'new'), ('recorded', 'unchanged'), ('changed', 'drifted'), ('absent', 'not_published')) s(moment, state)",
    "raw_provenance": f"SELECT {_NAME} AS _source_filename, count(*) AS n, 1::BIGINT AS batches, true AS batch_id, true AS loader, true AS now FROM yellow_tripdata WHERE {_IN_MONTHS} GROUP BY 1",
    "month_pipeline": f"""WITH{_STAGED} SELECT trip_bk, pickup_month, p.zone_name AS pu_zone, o.zone_name AS do_zone, source_filename
FROM st LEFT JOIN dim_zones p ON p.location_id = pu_location_id LEFT JOIN dim_zones o ON o.location_id = do_location_id WHERE invalid_reason IS NULL""",
    "table_operations": """WITH z AS (SELECT count(*) n, count(*) FILTER (WHERE location_id <= 5) five FROM dim_zones WHERE location_id IS NOT NULL)
SELECT step, schema, CASE k WHEN 0 THEN n WHEN 1 THEN n + five WHEN 2 THEN n + five + 1 END::BIGINT AS n FROM z, (VALUES ('written', 'a', 0), ('written', 'b', 9), ('upserted', 'a', 0), ('upserted', 'b', 1), ('inserted', 'a', 0), ('inserted', 'b', 2),
  ('swapped', 'a', 2), ('swapped', 'b', 0), ('dropped', 'a', 2), ('dropped', 'b', 9)) s(step, schema, k)""",
    "data_tests": """SELECT * FROM (SELECT 'load time' AS name, 'warn' AS severity, count(*) FILTER (WHERE _loaded_at IS NULL) AS n FROM yellow_tripdata UNION ALL SELECT 'payment', 'error', count(*) FILTER (WHERE payment_type NOT BETWEEN 1 AND 6) FROM yellow_tripdata
UNION ALL SELECT 'fare', 'error', count(*) FILTER (WHERE fare_amount < 0 OR fare_amount > 1000) FROM yellow_tripdata UNION ALL SELECT 'known zones', 'warn', count(*) FROM yellow_tripdata WHERE PULocationID NOT IN (SELECT location_id FROM dim_zones WHERE location_id IS NOT NULL)) WHERE n > 0""",
    "stream_loads": f"SELECT {_COLUMNS} FROM yellow_tripdata",
    "stream_hours": "SELECT date_trunc('hour', tpep_pickup_datetime)::TIMESTAMP AS hour, PULocationID, count(*) AS trip_count, sum(total_amount)::DECIMAL(38,4) AS gross_revenue FROM yellow_tripdata WHERE tpep_pickup_datetime IS NOT NULL GROUP BY 1, 2",
}
