from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cabstrata.plans import pipeline
from cabstrata.sources import bronze, files, months
from cabstrata.sources.tables import Lake
from cabstrata.streaming.files import append_available, hourly_counts, stream_files


def test_months():
    assert [str(m) for m in months.parse_months("2023-02, 2023-01,2023-02")] == ["2023-02", "2023-01"]
    assert len(months.parse_months("2023")) == 12
    for bad in ("", "23", "2023-13", "2023-1"):
        with pytest.raises(ValueError):
            months.parse_months(bad)
    assert [str(m) for m in months.months_between("2022-12", "2023-02")] == ["2022-12", "2023-01", "2023-02"]
    today = date(2024, 3, 5)
    assert str(months.target_month(today)) == "2024-01"
    assert str(months.target_month(today, interval_start=date(2023, 5, 1))) == "2023-05"
    assert str(months.target_month(today, interval_start=date(2024, 3, 1))) == "2024-01"
    assert str(months.target_month(today, 2023, 7)) == "2023-07"
    with pytest.raises(ValueError):
        months.target_month(today, 2024, 2)


def write_file(spark, path, rows, narrow=False):
    kind = "long" if narrow else "int"
    schema = f"VendorID {kind}, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string, PULocationID {kind}, DOLocationID {kind}, payment_type {kind}, fare_amount double, tip_amount double, total_amount double"
    df = spark.createDataFrame(rows, schema)
    if narrow:
        df = df.drop("RatecodeID").withColumnRenamed("trip_distance", "Trip_Distance")
    tmp = f"{path}.d"
    df.coalesce(1).write.mode("overwrite").parquet(tmp)
    import glob
    import os
    import shutil

    shutil.copy(glob.glob(f"{tmp}/*.parquet")[0], path)
    for crc in glob.glob(f"{os.path.dirname(path)}/.*.crc"):
        os.remove(crc)
    shutil.rmtree(tmp)


def trip(day, minute, pu=1, fare=10.0, pay=1, month=1):
    t = datetime(2024, month, day, 8) + timedelta(minutes=minute)
    return (1, t, t + timedelta(minutes=10), 1.0, 2.0, 1.0, "N", pu, 2, pay, fare, 1.0, fare + 2)


@pytest.fixture
def place(tmp_path):
    for d in ("origin", "mirror", "lake"):
        (tmp_path / d).mkdir()
    return tmp_path


@pytest.fixture
def zones(spark):
    return spark.createDataFrame([(1, "B", "One", "S"), (2, "B", "Two", "S")], bronze.ZONES)


def test_month_end_to_end(spark, place, zones):
    origin, mirror = f"{place}/origin", f"{place}/mirror"
    lake = Lake(spark, f"file://{place}/lake")
    jan, feb = months.parse_months("2024-01,2024-02")
    write_file(spark, f"{origin}/{jan.filename}", [trip(1, 0), trip(1, 0), trip(1, 90), trip(2, 0, pu=2), trip(3, 0, fare=-5.0), (1, None, None, *trip(1, 0)[3:])])

    def go(m, at):
        return pipeline.run_month(lake, origin, mirror, zones, m, at, least=10)

    def counts():
        p = {t: lake.read(pipeline.PUBLISHED, t) for t in lake.tables(pipeline.PUBLISHED)}
        current = lake.read(pipeline.SNAPSHOTS, "trips").where("valid_to is null").count()
        assert p["fct_trips"].count() + p["fct_trips_quarantined"].count() == current
        for m in ("agg_zone_revenue_monthly", "agg_hourly_demand_monthly", "agg_zone_supply_gaps_daily", "agg_zone_tip_behaviour_monthly", "agg_zone_revenue_yearly", "agg_hourly_demand_yearly", "agg_zone_tip_behaviour_yearly"):
            assert p[m].agg(F.sum("trip_count")).head()[0] == p["fct_trips"].count(), m
        assert pipeline.pending_rebuilds(lake).count() == 0
        return p["fct_trips"].count(), p["fct_trips_quarantined"].count()

    assert go(feb, "2024-03-01 00:00:00") == "not_published"
    assert go(jan, "2024-03-01 00:00:00") == "new" and counts() == (3, 2)
    assert go(jan, "2024-03-02 00:00:00") == "unchanged" and counts() == (3, 2)
    assert lake.read(pipeline.RAW, "yellow_tripdata").count() == 6

    # February: other types, no rate code, a trip of January that has become invalid.
    write_file(spark, f"{origin}/{feb.filename}", [trip(1, 0, month=2), trip(2, 0, month=2, pay=0), trip(1, 90, pay=0)], narrow=True)
    assert go(feb, "2024-04-01 00:00:00") == "new"
    fact = lake.read(pipeline.PUBLISHED, "fct_trips")
    assert fact.count() == 3 and fact.where("pickup_month = 2").count() == 1
    history = lake.read(pipeline.SNAPSHOTS, "trips")
    assert history.where("valid_to is not null").count() == 1

    # January comes again, corrected: its old rows go everywhere.
    write_file(spark, f"{origin}/{jan.filename}", [trip(1, 0, fare=20.0), trip(4, 0)])
    assert pipeline.detect_drift(lake, origin, jan) == "drifted"
    assert go(jan, "2024-05-01 00:00:00") == "drifted"
    fact = lake.read(pipeline.PUBLISHED, "fct_trips")
    assert {(r.pickup_date.isoformat(), r.fare_amount) for r in fact.collect()} == {("2024-01-01", 20.0), ("2024-01-04", 10.0), ("2024-02-01", 10.0)}
    assert lake.publish_views(pipeline.PUBLISHED, "m_") and spark.sql("select count(*) from m_fct_trips").head()[0] == 3
    assert lake.vacuum()
    assert lake.read(pipeline.PUBLISHED, "fct_trips").count() == 3
    assert "agg_zone_revenue_monthly" in lake.register(pipeline.PUBLISHED, "m")
    assert spark.sql("select sum(trip_count) from m.agg_zone_revenue_monthly").head()[0] == 3
    spark.sql("drop database m cascade")


def directories(lake):
    """The leaf directories of the lake that hold files."""
    import os

    top = lake.root.removeprefix("file://")
    return {os.path.relpath(d, top) for d, _, names in os.walk(top) if any(n.endswith(".parquet") for n in names)}


def test_a_month_writes_its_own_partitions_only(spark, place, zones):
    lake = Lake(spark, f"file://{place}/lake")
    go = lambda m, at: pipeline.run_month(lake, f"{place}/origin", f"{place}/mirror", zones, m, at, least=10)
    first = months.parse_months("2022-11,2022-12,2023-01,2023-02")
    for k, m in enumerate(first):
        write_file(spark, f"{place}/origin/{m.filename}", [tuple(x.replace(year=m.year) if isinstance(x, datetime) else x for x in trip(d, 0, month=m.month)) for d in (1, 2)] + [(1, None, None, *trip(1, 0)[3:])])
        assert go(m, f"2023-03-0{k + 1} 00:00:00") == "new"
    assert lake.read(pipeline.PUBLISHED, "fct_trips").count() == 8
    for m, at in ((months.Month(2023, 3), "2023-06-01 00:00:00"), (first[3], "2023-06-02 00:00:00")):
        before = directories(lake)
        write_file(spark, f"{place}/origin/{m.filename}", [tuple(x.replace(year=m.year) if isinstance(x, datetime) else x for x in trip(5, 0, month=m.month))])
        assert go(m, at) in ("new", "drifted")
        new = directories(lake) - before
        assert new and all(f"={m}" in d or "=none" in d or (d.split("/")[1].endswith("_yearly") and f"={m.year}" in d) or d.split("/")[1] == "source_fingerprints" for d in new), new
        assert before <= directories(lake)
    # The corrected file lost a trip of its month and gained another.
    assert {r.d for r in lake.read(pipeline.PUBLISHED, "fct_trips").where("pickup_year = 2023").selectExpr("cast(pickup_date as string) d").collect()} == {"2023-01-01", "2023-01-02", "2023-02-05", "2023-03-05"}
    assert lake.pending("months") == lake.pending("files") == set()


def test_a_drifted_file_that_fails_leaves_what_is_published(spark, place, zones, monkeypatch):
    """Neither a failing test nor a broken file empties the facts, and the next good run makes up for it."""
    lake = Lake(spark, f"file://{place}/lake")
    (jan,) = months.parse_months("2024-01")
    origin = f"{place}/origin/{jan.filename}"
    go = lambda at: pipeline.run_month(lake, f"{place}/origin", f"{place}/mirror", zones, jan, at)
    # One trip of the file is of February; the corrected file doesn't have it.
    write_file(spark, origin, [trip(1, 0), trip(2, 0), trip(3, 0, month=2)])
    go("2024-03-01 00:00:00")
    (place / "origin" / jan.filename).write_bytes(b"broken")
    with pytest.raises(Exception, match="Parquet|FOOTER|FAILED_READ_FILE"):
        go("2024-03-02 00:00:00")
    assert lake.read(pipeline.RAW, "yellow_tripdata").count() == lake.read(pipeline.PUBLISHED, "fct_trips").count() == 3
    write_file(spark, origin, [trip(1, 0, fare=20.0)])
    with monkeypatch.context() as p:
        p.setattr(pipeline, "build_checks", lambda *a: [pipeline.dq.RowCheck("never", "fct_trips", F.lit(True))])
        with pytest.raises(pipeline.ChecksFailed):
            go("2024-03-03 00:00:00")
    assert lake.read(pipeline.PUBLISHED, "fct_trips").count() == 3
    assert lake.read(pipeline.PUBLISHED, "agg_zone_revenue_monthly").agg(F.sum("trip_count")).head()[0] == 3
    assert go("2024-03-04 00:00:00") == "drifted"
    assert [(r.fare_amount, r.pickup_month) for r in lake.read(pipeline.PUBLISHED, "fct_trips").collect()] == [(20.0, 1)]
    assert pipeline.pending_rebuilds(lake).count() == 0 and lake.read(pipeline.PUBLISHED, "agg_zone_supply_gaps_daily").count() == 1


def test_a_load_stops_at_a_missing_or_broken_file(spark, place):
    lake = Lake(spark, f"file://{place}/lake")
    write_file(spark, f"{place}/origin/yellow_tripdata_2024-01.parquet", [trip(1, 0)])
    (place / "origin" / "bad.parquet").write_bytes(b"no parquet")
    good, bad, none = (f"{place}/origin/{n}.parquet" for n in ("yellow_tripdata_2024-01", "bad", "none"))
    for paths in ([good, bad], [good, none], []):
        with pytest.raises(Exception):  # noqa: B017
            pipeline.load_bronze(lake, paths)
    assert not lake.exists(pipeline.RAW, "yellow_tripdata") or lake.read(pipeline.RAW, "yellow_tripdata").count() == 0
    rows, skipped = bronze.read_present(spark, [good, bad, none])
    assert rows.count() == 1 and [p for p, _ in skipped] == [bad, none] and all(reason for _, reason in skipped)


def test_commands(spark, place, capsys):
    from cabstrata import __main__ as cli

    (place / "z.csv").write_text("location_id,borough,zone_name,service_zone\n1,A,B,C\n")
    write_file(spark, f"{place}/origin/yellow_tripdata_2024-01.parquet", [trip(1, 0), trip(1, 90)])
    base = ["--lake", f"file://{place}/lake", "--origin", f"{place}/origin", "--mirror", f"{place}/mirror", "--zones", f"{place}/z.csv"]
    assert cli.main(["month", *base, "--months", "2024-01"], spark) == cli.OK
    assert cli.main(["month", *base, "--months", "2024-02"], spark) == cli.NOT_PUBLISHED
    assert cli.main(["year", *base, "--year", "2024"], spark) == cli.OK
    capsys.readouterr()
    assert cli.main(["sql", *base, "--name", "select sum(trip_count) as n from marts_agg_zone_revenue_monthly"], spark) == cli.OK and "|2  |" in capsys.readouterr().out
    assert cli.main(["clone", *base, "--source", "marts", "--target", "copy"], spark) == cli.OK and "copy" in Lake(spark, f"file://{place}/lake").schemas()
    for c in ("status", "drop-historical", "vacuum"):
        assert cli.main([c, *base], spark) == cli.OK
    args = cli.parser().parse_args(["month", "--lag-months", "3"])
    assert cli.month_of(args, date(2024, 3, 5)) == "2023-12"
    args = cli.parser().parse_args(["month", "--interval-start", "2023-05-01"])
    assert cli.month_of(args, date(2024, 3, 5)) == "2023-05"
    with pytest.raises(ValueError):
        cli.month_of(cli.parser().parse_args(["month", "--months", "2024-02"]), date(2024, 3, 5))


def test_a_failing_check_leaves_what_is_published(spark, place, zones, monkeypatch):
    lake = Lake(spark, f"file://{place}/lake")
    (jan,) = months.parse_months("2024-01")
    write_file(spark, f"{place}/origin/{jan.filename}", [trip(1, 0)])
    pipeline.run_month(lake, f"{place}/origin", f"{place}/mirror", zones, jan, "2024-03-01 00:00:00")
    before = lake._load()["schemas"][pipeline.PUBLISHED]
    monkeypatch.setattr(pipeline, "build_checks", lambda *a: [pipeline.dq.Check("never", lambda x: x["fct_trips"])])
    with pytest.raises(pipeline.ChecksFailed):
        pipeline.run_month(lake, f"{place}/origin", f"{place}/mirror", zones, jan, "2024-03-02 00:00:00")
    assert lake._load()["schemas"][pipeline.PUBLISHED] == before


def test_year_twice_changes_nothing(spark, place):
    lake = Lake(spark, f"file://{place}/lake")
    for m in months.parse_months("2023-12,2024-01"):
        write_file(spark, f"{place}/origin/{m.filename}", [trip(1, 0), trip(1, 90), trip(1, 90, pay=0)] + ([(1, datetime(2023, 12, 1), datetime(2023, 12, 1, 1), *trip(1, 0)[3:])] if m.month == 1 else []))
    (place / "origin" / "yellow_tripdata_2024-02.parquet").write_bytes(b"no parquet")
    for _ in range(2):
        assert [p.rsplit("/", 1)[1] for p, _ in pipeline.run_year(lake, f"{place}/origin", 2024)] == ["yellow_tripdata_2024-02.parquet"]
        daily, gaps = lake.read(pipeline.HISTORICAL, "daily_agg"), lake.read(pipeline.HISTORICAL, "supply_gaps")
        assert daily.agg(F.sum("trip_count"), F.min(F.year("pickup_date"))).head()[:] == (2, 2024)
        assert gaps.head().longest_gap_min == 90.0
    pipeline.drop_historical(lake)
    assert lake.tables(pipeline.HISTORICAL) == []
    with pytest.raises(FileNotFoundError):
        bronze.read_present(spark, [f"{place}/origin/none.parquet"])


def test_lake(spark, place):
    lake = Lake(spark, f"file://{place}/lake")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    lake.write("x", "t", df, by=["s"], sort_by=["i"])
    lake.append("x", "t", df.withColumn("n", F.lit(1)))
    assert lake.read("x", "t").count() == 4 and lake.exists("x", "t") and not lake.exists("y", "t")
    lake.clone("x", "y")
    lake.upsert("y", "t", df.limit(1).select("i", F.lit("z").alias("s")), ["i"])
    assert lake.read("x", "t").count() == 4 and lake.read("y", "t").where("s = 'z'").count() == 1
    lake.delete_insert("y", "t", df, ["i"])
    assert lake.read("y", "t").count() == 2
    lake.swap("x", "y")
    assert lake.read("x", "t").count() == 2 and lake.schemas() == ["x", "y"]
    lake.drop("x", ["t", "none"])
    assert lake.tables("x") == []


def test_partitions(spark, place, monkeypatch):
    from cabstrata.sources import tables

    lake = Lake(spark, f"file://{place}/lake")
    df = spark.createDataFrame([(1, "a/b=c"), (2, None), (3, "x")], "i int, s string")
    lake.write("x", "t", df, by=["s"])
    assert lake.parts("x", "t") == {"a/b=c", "none", "x"} and lake.read("x", "t", {"none"}).collect() == [(2, None)]
    lake.replace("x", "t", spark.createDataFrame([(9, "x", 1)], "i int, s string, n int"), {"x", "none"})
    assert sorted(map(tuple, lake.read("x", "t").collect())) == [(1, "a/b=c", None), (9, "x", 1)]
    with pytest.raises(ValueError):
        lake.replace("x", "t", df, {"x"}, strict=True)
    lake.upsert("x", "t", spark.createDataFrame([(9, "x", 2), (5, "new", 3)], "i int, s string, n int"), ["i", "s"], within=True)
    assert sorted(map(tuple, lake.read("x", "t").collect())) == [(1, "a/b=c", None), (5, "new", 3), (9, "x", 2)]
    monkeypatch.setattr(tables, "COMPACT_AT", 3)
    for i in range(9):
        lake.append("x", "t", spark.createDataFrame([(i, "x", 0)], "i int, s string, n int"))
    assert lake.read("x", "t", {"x"}).count() == 10 and len(lake._table("x", "t")["parts"]["x"]) <= 4
    assert len(lake._table("x", "t")["parts"]["a/b=c"]) == 1
    assert lake.vacuum() and lake.read("x", "t").count() == 12 and lake.vacuum() == []
    lake.replace("x", "t", spark.createDataFrame([(7, "late", 0)], "i int, s string, n int"), ())
    assert lake.latest("x", "t", 1) == {"late"} and lake.latest("x", "t") == lake.parts("x", "t")
    lake.write("x", "e", df.limit(0), by=["s"])
    assert lake.read("x", "e").count() == 0 and lake.read("x", "e").columns == ["i", "s"]


def test_files(spark, place):
    src = place / "origin" / "yellow_tripdata_2024-01.parquet"
    src.write_bytes(b"abc")
    ms = months.parse_months("2024-01,2024-02")
    new = files.ingest_missing(spark, ms, f"{place}/origin", f"{place}/mirror")
    assert [p.rsplit("/", 1)[1] for p in new] == [src.name] and (place / "mirror" / src.name).read_bytes() == b"abc"
    assert files.ingest_missing(spark, ms, f"{place}/origin", f"{place}/mirror") == []
    assert len(files.ingest_missing(spark, ms, f"{place}/origin", f"{place}/mirror", force=True)) == 1
    assert files.drift_status(None, "x") == "not_published" and files.drift_status(("a", "", 1), None) == "new" and files.drift_status(("a", "", 1), "a") == "unchanged"


def test_zone_file(spark, place):
    (place / "z.csv").write_text('location_id,borough,zone_name,service_zone\n1,"A","B, C",D\n264,Unknown,N/A,\n')
    assert [tuple(r) for r in bronze.read_zones(spark, f"{place}/z.csv").collect()] == [(1, "A", "B, C", "D"), (264, "Unknown", "N/A", None)]


def test_stream(spark, place):
    lake = Lake(spark, f"file://{place}/lake")
    df = bronze.empty_bronze(spark).drop("_source_filename", "_ingest_batch_id", "_loaded_by", "_loaded_at")
    row = [1, datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 9), *[None] * (len(df.columns) - 3)]
    (place / "in").mkdir()
    spark.createDataFrame([tuple(row)], df.schema).coalesce(1).write.mode("append").parquet(f"{place}/in")
    args = (spark, lake, "raw", "t", f"{place}/in", f"{place}/cp")
    assert append_available(*args) == 1 and append_available(*args) == 0
    spark.createDataFrame([tuple(row)] * 2, df.schema).coalesce(1).write.mode("append").parquet(f"{place}/in")
    assert append_available(*args) == 1
    # Another folder with a checkpoint of its own begins at batch 0 as well, and is no repetition.
    (place / "in2").mkdir()
    spark.createDataFrame([tuple(row)], df.schema).coalesce(1).write.mode("append").parquet(f"{place}/in2")
    assert append_available(spark, lake, "raw", "t", f"{place}/in2", f"{place}/cp2") == 1
    # A batch whose commit was lost is run again and written once.
    import os

    last = max(os.listdir(f"{place}/cp/commits"), key=lambda n: (n.isdigit(), int(n) if n.isdigit() else -1))
    for name in (last, f".{last}.crc"):
        os.remove(f"{place}/cp/commits/{name}")
    assert append_available(*args) == 0
    t = lake.read("raw", "t")
    assert t.select("_ingest_batch_id").distinct().count() == 3
    t = t.where("_source_filename is not null")
    assert t.count() == 4 and t.where("_source_filename is null or _ingest_batch_id is null").count() == 0
    q = hourly_counts(stream_files(spark, f"{place}/in")).writeStream.format("memory").queryName("hours").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select sum(trip_count) from hours").head()[0] == 3
