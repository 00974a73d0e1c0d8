"""A month and a year from raw files to published tables.

A month: check for drift, mirror and load the file (a drifted one replaces its old rows in the same step),
bring the history up to date, build aside on a clone of what is published, test, swap, and only then
record the file's fingerprint. A failing step leaves the published tables as they were.

Everything is done by month of pickup. The raw table is partitioned by file and month, so the months a
file touches, before and after a correction, are read from the pointer file; history, facts, rows set
aside and marts of other months are neither read nor written. Months that lose rows to a correction are
noted in the step that takes them, until they are published: the next good run makes up for one that failed.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstrata.operators import dq, scd2, upsert
from cabstrata.plans import historical, marts, staging
from cabstrata.sources import bronze, files
from cabstrata.sources.months import Month, months_between, months_of_year
from cabstrata.sources.tables import NONE, SEP, Lake

RAW, SNAPSHOTS, PUBLISHED, BUILD, HISTORICAL = "raw", "snapshots", "marts", "marts_build", "historical"
STATE = "filename string, etag string, last_modified string, content_length bigint, recorded_at timestamp"
#: SQL for the partition of a row: its file's bare name, and the month of a date or time.
FILE = r"lower(trim(element_at(split(_source_filename, '[/\\\\]'), -1)))"
MONTH = "substring(cast({} as string), 1, 7)"
CHECKED = [c for c, _ in bronze.SOURCE if c not in ("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID")]


class ChecksFailed(RuntimeError):
    pass


def stored_etag(lake: Lake, filename: str) -> str | None:
    if not lake.exists(RAW, "source_fingerprints"):
        return None
    r = lake.read(RAW, "source_fingerprints").where(F.col("filename") == filename).select("etag").head()
    return r and r.etag


def detect_drift(lake: Lake, origin: str, month: Month) -> str:
    return files.drift_status(files.fingerprint(lake.spark, f"{origin}/{month.filename}"), stored_etag(lake, month.filename))


def record_fingerprint(lake: Lake, origin: str, month: Month) -> None:
    etag, modified, length = files.fingerprint(lake.spark, f"{origin}/{month.filename}")
    row = lake.spark.createDataFrame([(month.filename, etag, modified, length)], "filename string, etag string, last_modified string, content_length bigint")
    lake.upsert(RAW, "source_fingerprints", row.withColumn("recorded_at", F.current_timestamp()), ["filename"])


def load_bronze(lake: Lake, paths: list[str], batch_id: str | None = None, loaded_by: str = "cabstrata", replaces: str | None = None) -> DataFrame:
    """Appends the files to the raw table; one that is missing or broken stops the load before anything
    is written. With replaces (a file's name) the rows that the table has of that file go in the same
    step: a correction is seen whole or not at all."""
    return append_rows(lake, bronze.with_load(bronze.read_all(lake.spark, paths), batch_id, loaded_by), replaces)


def append_rows(lake: Lake, rows: DataFrame, replaces: str | None = None) -> DataFrame:
    """Appends rows with their load columns and notes the months to be built and the file replaced."""
    lake.ensure(RAW, "yellow_tripdata", bronze.empty_bronze(lake.spark), by=[FILE, MONTH.format("tpep_pickup_datetime")])
    before = lake.parts(RAW, "yellow_tripdata")
    gone = {k for k in before if replaces and k.startswith(f"{replaces.lower()}{SEP}")}
    return lake.replace(RAW, "yellow_tripdata", rows, gone, pending={"months": {k.split(SEP)[1] for k in gone}, "files": {replaces.lower()} if gone else set()})


def months_of_file(lake: Lake, filename: str) -> set[str]:
    """The months of pickup in which a file has rows, from the pointer file."""
    return {k.split(SEP)[1] for k in lake.parts(RAW, "yellow_tripdata") if k.startswith(f"{filename.lower()}{SEP}")}


def raw_months(lake: Lake, months: set[str]) -> DataFrame:
    """The raw rows of these months of pickup, whatever files they stand in."""
    return lake.read(RAW, "yellow_tripdata", lambda k: k.split(SEP)[1] in months)


def apply_snapshot(lake: Lake, at: str, months: set[str] | None = None) -> DataFrame:
    """Brings the history of these months (all without any) up to date. A trip's key holds its pickup, so
    all copies and versions of a trip are in one month. Versions from the old rows of a replaced file go:
    a trip whose key changed in the new version of the file would otherwise stay current."""
    if months is None:
        months = {k.split(SEP)[1] for k in lake.parts(RAW, "yellow_tripdata")} | lake.parts(SNAPSHOTS, "trips")
    current = staging.snapshot(raw_months(lake, months))
    if not lake.exists(SNAPSHOTS, "trips"):
        new = scd2.scd2_start(current, at)
    else:
        old = upsert.synced(lake.read(SNAPSHOTS, "trips", months), [*current.columns, "valid_from", "valid_to"])
        for f in sorted(lake.pending("files")):
            old = upsert.delete_by_file(old, f, "_source_filename")
        new = scd2.scd2_apply(old, current, "trip_bk", CHECKED, at)
    out = lake.replace(SNAPSHOTS, "trips", new, months, by=[MONTH.format("tpep_pickup_datetime")], strict=True, sync=True)
    lake.settle("files")
    return out


def build_marts(lake: Lake, zones: DataFrame, months: set[str]) -> set[str]:
    """Facts, rows set aside and marts of these months, in the build schema; all months on a first run.
    Returns the months built. A trip is in exactly one of facts and rows set aside, as both come from the
    same reading of the history."""
    lake.clone(PUBLISHED, BUILD)
    if not lake.exists(BUILD, "fct_trips"):
        months = lake.parts(SNAPSHOTS, "trips")
    staged = staging.stage(lake.read(SNAPSHOTS, "trips", months).where("valid_to is null"))
    dated = {m for m in months if m != NONE}
    years = {m.split("-")[0] for m in dated}

    def put(name: str, df: DataFrame, keys: set[str], by: str, sort_by: list[str] | None = None) -> None:
        lake.replace(BUILD, name, df, keys, by=[by], sort_by=sort_by, strict=True, sync=True)

    put("fct_trips", staging.facts(staged, zones), dated, MONTH.format("pickup_date"), ["pickup_date", "pu_location_id"])
    put("fct_trips_quarantined", staging.quarantine(staged, zones), months, MONTH.format("pickup_date"))
    fact = lake.read(BUILD, "fct_trips", dated)
    for name, make in (("agg_zone_revenue_monthly", marts.zone_revenue_monthly), ("agg_hourly_demand_monthly", marts.hourly_demand_monthly), ("agg_zone_tip_behaviour_monthly", marts.tip_behaviour_monthly)):
        put(name, marts.built_now(make(fact)), dated, "format_string('%04d-%02d', pickup_year, pickup_month)", ["pu_location_id"] if "zone" in name else None)
    put("agg_zone_supply_gaps_daily", marts.built_now(marts.supply_gaps(fact)), dated, MONTH.format("pickup_date"), ["pickup_date", "pu_location_id"])
    yearly = (("agg_zone_revenue", "monthly", marts.zone_revenue_yearly), ("agg_hourly_demand", "monthly", marts.hourly_demand_yearly), ("agg_zone_tip_behaviour", "monthly", marts.tip_behaviour_yearly), ("agg_zone_supply_gaps", "daily", marts.supply_gaps_yearly))
    for name, grain, make in yearly:
        put(f"{name}_yearly", marts.built_now(make(lake.read(BUILD, f"{name}_{grain}", lambda k: k.split("-")[0] in years))), years, "format_string('%04d', pickup_year)")
    return months


def build_checks(tolerance: float = 0.40, least: int = 10_000) -> list[dq.Check | dq.RowCheck]:
    keys = {
        "fct_trips": ["trip_bk"], "fct_trips_quarantined": ["quarantine_key"], "agg_zone_revenue_monthly": ["pickup_year", "pickup_month", "pu_location_id"],
        "agg_zone_revenue_yearly": ["pickup_year", "pu_location_id"], "agg_hourly_demand_monthly": ["pickup_year", "pickup_month", "pickup_dow", "pickup_hour"],
        "agg_hourly_demand_yearly": ["pickup_year", "pickup_dow", "pickup_hour"], "agg_zone_supply_gaps_daily": ["pickup_date", "pu_location_id"], "agg_zone_supply_gaps_yearly": ["pickup_year", "pu_location_id"],
        "agg_zone_tip_behaviour_monthly": ["pickup_year", "pickup_month", "pu_location_id", "distance_bucket", "payment_type"], "agg_zone_tip_behaviour_yearly": ["pickup_year", "pu_location_id", "distance_bucket", "payment_type"],
    }
    out: list[dq.Check | dq.RowCheck] = [dq.Check(f"unique {t}", lambda x, t=t, k=k: dq.unique(x[t], k), "warn" if t == "fct_trips_quarantined" else "error") for t, k in keys.items()]
    out += [dq.RowCheck(f"not null {t}.{c}", t, dq.is_missing(c)) for t, c in (("fct_trips", "trip_bk"), ("fct_trips", "pickup_ts"), ("fct_trips", "pu_location_id"), ("fct_trips_quarantined", "invalid_reason"), ("agg_zone_revenue_monthly", "trip_count"))]
    out += [
        dq.RowCheck("duration", "fct_trips", dq.is_insane_duration("trip_duration_min", 720)),
        dq.RowCheck("pickup hour", "fct_trips", dq.is_outside("pickup_hour", 0, 23)),
        dq.RowCheck("payment type", "fct_trips", dq.is_unaccepted("payment_type", [1, 2, 3, 4, 5, 6])),
        dq.RowCheck("distance bins", "agg_zone_tip_behaviour_monthly", dq.is_unaccepted("distance_bucket", [*[b for _, b in marts.DISTANCE_BINS], marts.LAST_BIN])),
        dq.Check("known zones", lambda x: dq.relationships(x["fct_trips"], "pu_location_id", x["dim_zones"], "location_id"), "warn"),
        dq.Check("rows by month", lambda x: dq.period_counts(x["all_months"], ["pickup_year", "pickup_month"], tolerance, least, "trip_count"), "warn"),
        dq.Check("one current version", lambda x: dq.one_current(x["snapshot"], "trip_bk")),
        dq.Check("marts add up", lambda x: dq.reconcile(x["fct_trips"], x["agg_zone_revenue_monthly"], ["pickup_year", "pickup_month"], "agg_zone_revenue_monthly")),
        dq.Check("fresh", lambda x: dq.freshness(x["raw"], "_loaded_at", x["now"]).where("status != 'pass'"), "warn"),
    ]
    return out


def checked_tables(lake: Lake, zones: DataFrame, months: set[str]) -> dict:
    """What the tests read: of facts, history and marts the months just built, as the others were tested
    when they were; the counts by month from the mart, which a test holds against the facts; of the raw table what was loaded
    last, as that has the latest load time."""
    years = {m.split("-")[0] for m in months}

    def scope(table: str):
        return (lambda k: k in years) if table.endswith("_yearly") else (lambda k: k in months)

    tables = {t: lake.read(BUILD, t, scope(t)) for t in lake.tables(BUILD)}
    more = {"dim_zones": zones, "snapshot": lake.read(SNAPSHOTS, "trips", months), "all_months": lake.read(BUILD, "agg_hourly_demand_monthly"), "raw": lake.read(RAW, "yellow_tripdata", lake.latest(RAW, "yellow_tripdata")), "now": f"{date.today()} 00:00:00"}
    return tables | more


def monthly_marts(read) -> dict[str, DataFrame]:
    """The four marts of months and days by name, with their months; read gives a mart by its name."""
    daily = read("agg_zone_supply_gaps_daily").withColumns({"pickup_year": F.year("pickup_date"), "pickup_month": F.month("pickup_date")})
    return {m: read(m) for m in ("agg_hourly_demand_monthly", "agg_zone_revenue_monthly", "agg_zone_tip_behaviour_monthly")} | {"agg_zone_supply_gaps_daily": daily}


def pending_rebuilds(lake: Lake, schema: str = PUBLISHED) -> DataFrame:
    """Months in which a mart doesn't add up to the facts."""
    return dq.reconcile_all(lake.read(schema, "fct_trips"), monthly_marts(lambda m: lake.read(schema, m)), ["pickup_year", "pickup_month"])


def run_month(lake: Lake, origin: str, mirror: str, zones: DataFrame, month: Month, at: str | None = None, tolerance: float = 0.40, least: int = 10_000) -> str:
    """Runs a month and returns its drift status. A file that isn't published yet ends the run; an
    unchanged one is loaded no second time but built again, and so are rows without a date."""
    status = detect_drift(lake, origin, month)
    if status == "not_published":
        return status
    new = files.ingest_missing(lake.spark, [month], origin, mirror, force=status == "drifted")
    if new or not months_of_file(lake, month.filename):
        load_bronze(lake, [f"{mirror}/{month.filename}"], replaces=month.filename)
    months = months_of_file(lake, month.filename) | lake.pending("months") | {NONE}
    apply_snapshot(lake, at or f"{date.today()} 00:00:00", months)
    built = build_marts(lake, zones, months)
    errors = [f for f in dq.run_checks(build_checks(tolerance, least), checked_tables(lake, zones, built)) if f[1] == "error"]
    if errors:
        raise ChecksFailed(", ".join(f"{n}: {k}" for n, _, k in errors))
    lake.swap(PUBLISHED, BUILD, settled="months")
    record_fingerprint(lake, origin, month)
    return status


def backfill(lake: Lake, origin: str, mirror: str, zones: DataFrame, first: str, last: str, **more) -> dict[str, str]:
    """Every month from first to last in order; stops at the first failure."""
    return {str(m): run_month(lake, origin, mirror, zones, m, **more) for m in months_between(first, last)}


# The historical tables as declared: partitioned by month of pickup, clustered by day and zone.
HISTORICAL_TABLES = {
    "daily_agg": "pickup_date date, pickup_hour int, pu_location_id int, payment_type int, trip_count bigint, gross_revenue double, total_fare double, total_tip double, total_distance_mi double, total_duration_sec bigint, distinct_vendors bigint",
    "supply_gaps": "pickup_date date, pu_location_id int, trip_count bigint, longest_gap_min double, avg_gap_min double, gaps_gt_1h bigint, gaps_gt_3h bigint, first_pickup_ts timestamp_ntz, last_pickup_ts timestamp_ntz",
    "tip_behaviour": "pickup_date date, pu_location_id int, distance_bucket string, payment_type int, trip_count bigint, total_fare double, total_tip double, total_distance_mi double",
}


def ensure_historical(lake: Lake) -> None:
    """Creates the historical tables that aren't there yet, empty, with their declared columns."""
    for name, columns in HISTORICAL_TABLES.items():
        lake.ensure(HISTORICAL, name, lake.spark.createDataFrame([], columns), by=[MONTH.format("pickup_date")], sort_by=["pickup_date", "pu_location_id"])


def run_year(lake: Lake, folder: str, year: int) -> list[tuple[str, str]]:
    """The three historical tables of a year, replaced as a whole: its months' partitions and no others.
    A year run twice changes nothing. Returns the files that couldn't be read, with the reason; months
    that aren't there are no files."""
    paths = [p for m in months_of_year(year) if files.exists(lake.spark, p := f"{folder}/{m.filename}")]
    rows, skipped = bronze.read_present(lake.spark, paths)
    ensure_historical(lake)
    trips = historical.historical_trips(bronze.with_load(rows), year).cache()
    try:
        for name, df in historical.year_aggregates(trips).items():
            declared = lake.read(HISTORICAL, name).columns
            lake.replace(HISTORICAL, name, df.select(*declared), lambda k: k.startswith(f"{year:04d}-"), strict=True)
    finally:
        trips.unpersist()
    return skipped


def drop_historical(lake: Lake) -> None:
    lake.drop(HISTORICAL, ["daily_agg", "supply_gaps", "tip_behaviour"])
