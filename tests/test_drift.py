import json
from datetime import datetime

from cabstrata.operators import drift

CATALOG = [("VendorID", "int64", "VendorID"), ("VendorID", "int64", "vendor_code"), ("fee", "double", "fee"), ("fee", "double", "cbd_fee"), ("at", "timestamp", "at"), ("flag", "string", "flag"), ("flag", "string", None)]


def catalog(spark):
    return spark.createDataFrame(CATALOG, "field_name string, field_type string, known_name string")


def test_changes(spark):
    def cols(month, *names):
        return [(f"yellow_tripdata_{month}_s0001.parquet", i, *n) for i, n in enumerate(names)]

    rows = [
        *cols("2024-01", ("VendorID", "int64"), ("fee", "double"), ("odd name", "string")),
        *cols("2024-03", ("vendor_code", "int32"), ("FEE", "double"), ("at", "timestamp")),
        *cols("2024-03", ("vendor_code", "int32"), ("FEE", "double"), ("at", "timestamp")),
        *cols("2024-04", ("at", "timestamp"), ("FEE", "double"), ("vendor_code", "int32"), ("Odd Name", "string"), ("odd name", None)),
        ("no_month.parquet", 1, "x", "y"), (None, 1, "x", "y"), ("yellow_tripdata_2024-04_s0001.parquet", 9, None, "y"),
    ]
    got = drift.schema_changes(spark.createDataFrame(rows, "filename string, ordinal int, column_name string, data_type string"), catalog(spark))
    a, b = "yellow_tripdata_2024-03_s0001.parquet", "yellow_tripdata_2024-04_s0001.parquet"
    assert {tuple(r) for r in got.collect()} == {(a, "VendorID", "renamed"), (a, "VendorID", "retyped"), (a, "fee", "renamed"), (a, "odd name", "removed"), (a, "at", "added"), (b, "Odd Name", "added"), (b, "odd name", "added")}
    assert drift.schema_changes(spark.createDataFrame([], "filename string, ordinal int, column_name string, data_type string"), catalog(spark)).count() == 0


def test_months_in_names(spark):
    """The month counts whatever follows it; a name without one is reported."""

    def cols(name, *columns):
        return [(name, i, *c) for i, c in enumerate(columns)]

    rows = [
        *cols("yellow_tripdata_2023-01.parquet", ("VendorID", "int64"), ("fee", "double")),
        *cols("raw/YELLOW_tripdata_2023-02.parquet ", ("VendorID", "int32"), ("Cbd_Fee", "double")),
        *cols("green_2023-02_x.parquet", ("VendorID", "int64")), *cols("no_month.parquet", ("fee", "double")), *cols("t_2023-13.parquet", ("fee", "double")), *cols("t_12023-01.parquet", ("fee", "double")),
    ]
    df = spark.createDataFrame(rows, "filename string, ordinal int, column_name string, data_type string")
    b = "raw/YELLOW_tripdata_2023-02.parquet "
    assert {tuple(r) for r in drift.schema_changes(df, catalog(spark)).collect()} == {(b, "VendorID", "retyped"), (b, "fee", "renamed")}
    assert {r[0] for r in drift.unplaced_files(df).collect()} == {"no_month.parquet", "t_2023-13.parquet", "t_12023-01.parquet"}


def test_headers_go_through_the_rescue_column(spark):
    rows = [("t_2024-01.parquet", 0, "odd", "string"), ("t_2024-01.parquet", 1, "FEE", "double"), ("t_2024-01.parquet", 2, "cbd_fee", "int64"), ("t_2024-02.parquet", 0, "odd", "string"), ("t_2024-02.parquet", 0, "odd", "int64")]
    df = spark.createDataFrame(rows, "filename string, ordinal int, column_name string, data_type string")
    schema = drift.Schema.of(catalog(spark))
    h = {r.month: r for r in drift.ingest_headers(df, schema).collect()}
    assert json.loads(h["2024-01"].fee) == {"ordinal": 1, "column_name": "FEE", "data_type": "double"} and set(json.loads(h["2024-01"]._rescued)) == {"odd", "cbd_fee"}
    assert {(r.field_name, r.column_name, r.data_type) for r in drift.header_fields(drift.ingest_headers(df, schema), schema).where("month = '2024-01'").collect()} == {("odd", "odd", "string"), ("fee", "FEE", "double")}


def test_first_spelling_in_file_order_counts(spark):
    rows = [("f", 1, '{"fee": 1, "cbd_fee": 2, "odd": "a", "odd": "b"}'), ("f", 2, '{"cbd_fee": 2, "fee": 1}'), ("f", 3, '{"q\\"x": "a\\nb", "n": {"m": [1]}, "z": null}')]
    schema = drift.Schema.of(catalog(spark))
    t = drift.ingest(spark.createDataFrame(rows, "filename string, row_no int, payload string"), schema)
    got = {r.row_no: r for r in t.collect()}
    assert got[1].fee == 1.0 and got[2].fee == 2.0 and "cbd_fee" in got[1]._rescued and json.loads(got[2]._rescued) == {"fee": "1"}
    assert json.loads(got[3]._rescued) == {'q"x': "a\nb", "n": '{"m":[1]}', "z": None}
    assert {(r.written_name, r.reason, r.n_records) for r in drift.rescued_report(t, schema).collect()} == {("cbd_fee", "uncastable", 1), ("odd", "unknown", 1), ("fee", "uncastable", 1), ('q"x', "unknown", 1), ("n", "unknown", 1), ("z", "unknown", 1)}


def test_rescue_and_replay(spark):
    rows = [
        ("f", 1, json.dumps({"vendor_code": "2.0", "FEE": "1.5", "at": "2024-01-02T03:04:05", "odd": 7})),
        ("f", 2, json.dumps({"VendorID": "x", "fee": None, "at": "01/02/2024 03:04:05", "flag": "Y"})),
        ("f", 3, '{"VendorID": 1, "fee":'), ("f", 4, None), ("f", 1, '{"broken'), ("f", 5, "{}"),
    ]
    schema = drift.Schema.of(catalog(spark))
    t = drift.ingest(spark.createDataFrame(rows, "filename string, row_no int, payload string"), schema)
    got = {r.row_no: r for r in t.collect()}
    assert (got[1].VendorID, got[1].fee, got[1].at, json.loads(got[1]._rescued)) == (2, 1.5, datetime(2024, 1, 2, 3, 4, 5), {"odd": "7"})
    assert (got[2].VendorID, got[2].fee, got[2].at, got[2].flag) == (None, None, None, "Y") and json.loads(got[2]._rescued) == {"VendorID": "x", "at": "01/02/2024 03:04:05"}
    assert json.loads(got[3]._rescued) == {"_broken": rows[2][2]}
    assert got[4]._rescued is None and got[5]._rescued is None and len(got) == 5
    later = schema.with_approved(names={"odd": "odd"}, types={"odd": "int64"}, formats=["MM/dd/yyyy HH:mm:ss"])
    again = {r.row_no: r for r in drift.replay(t, later).collect()}
    assert again[1].odd == 7 and again[1]._rescued is None and again[1].VendorID == 2
    assert again[2].at == datetime(2024, 1, 2, 3, 4, 5) and json.loads(again[2]._rescued) == {"VendorID": "x"}
    assert drift.ingest(spark.createDataFrame([], "filename string, row_no int, payload string"), schema).count() == 0
