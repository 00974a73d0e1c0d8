from datetime import datetime

from pyspark.sql import functions as F

from cabstrata.operators import sizing, snapshots

SCHEMA = "scope string, seq int, id string, v int, w int, at int"


def diff(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"change": F.lit("clash"), "_now": F.lit(1)})
    return {tuple(r) for r in snapshots.snapshot_diff(df, ["scope"], "seq", "id", ["v", "w"], F.struct("at")).select("scope", "seq", "id", "change").collect()}


ROWS = [
    ("f", 1, "a", 1, None, 0), ("f", 1, "b", None, 1, 0), ("f", 1, "c", 1, 1, 0), ("f", 1, "n", None, None, 0),
    ("f", 3, "a", 1, None, 0), ("f", 3, "b", 1, None, 0), ("f", 3, "d", 1, 1, 0), ("f", 3, "d", 1, 1, 0), ("f", 3, "n", None, None, 0),
    ("g", 1, "a", 1, 1, 0), ("g", 2, "a", 9, 9, 0), ("g", 2, "a", 1, 1, 5),
    ("h", 1, "a", 1, 1, 0), (None, 1, "a", 1, 1, 0), ("f", None, "a", 7, 7, 0), ("f", 3, None, 7, 7, 0),
]
WANT = {("f", 3, "b", "changed"), ("f", 3, "c", "removed"), ("f", 3, "d", "added")}


def test_added_removed_changed(spark):
    # b swaps a value and a null between two columns; the later of g's two rows equals the one before.
    assert diff(spark, ROWS) == WANT


def test_same_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(sizing, "is_small", lambda *a, **k: False)
    assert diff(spark, ROWS) == WANT


def test_empty(spark):
    assert diff(spark, []) == set()


def test_file_names_and_etags(spark):
    t = datetime(2024, 1, 1)
    rows = [(1, "x/A.parquet ", 'W/"AB"', t), (2, "a.parquet", "ab", t), (4, "a.parquet", '"cd"', t), (4, "b.parquet", None, t), (4, "b.parquet", None, t)]
    got = {tuple(r) for r in snapshots.file_changes(spark.createDataFrame(rows, "snapshot_id int, filename string, etag string, recorded_at timestamp_ntz")).collect()}
    assert got == {("file", "a.parquet", "4", "changed"), ("file", "b.parquet", "4", "added")}
