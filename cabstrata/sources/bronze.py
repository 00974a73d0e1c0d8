"""Raw files into the append-only table, with provenance on every row."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns and types of the raw table.
SOURCE = [
    ("VendorID", "int"), ("tpep_pickup_datetime", "timestamp_ntz"), ("tpep_dropoff_datetime", "timestamp_ntz"), ("passenger_count", "decimal(10,2)"), ("trip_distance", "decimal(18,4)"),
    ("RatecodeID", "decimal(10,2)"), ("store_and_fwd_flag", "string"), ("PULocationID", "int"), ("DOLocationID", "int"), ("payment_type", "int"), ("fare_amount", "decimal(18,4)"),
    ("extra", "decimal(18,4)"), ("mta_tax", "decimal(18,4)"), ("tip_amount", "decimal(18,4)"), ("tolls_amount", "decimal(18,4)"), ("improvement_surcharge", "decimal(18,4)"),
    ("total_amount", "decimal(18,4)"), ("congestion_surcharge", "decimal(18,4)"), ("airport_fee", "decimal(18,4)"), ("cbd_congestion_fee", "decimal(18,4)"),
]
LOADED = [("_source_filename", "string"), ("_ingest_batch_id", "string"), ("_loaded_by", "string"), ("_loaded_at", "timestamp")]
ZONES = "location_id int, borough string, zone_name string, service_zone string"


def _field(name: str, to: str, have: dict[str, tuple[str, str]]):
    """A field by name, whatever its case; a missing one is null; times may come as microseconds."""
    written, kind = have.get(name.lower(), (None, None))
    if written is None:
        return F.lit(None).cast(to).alias(name)
    c = F.col(f"`{written}`")
    if to == "timestamp_ntz" and kind in ("bigint", "int"):
        c = F.timestamp_micros(c.cast("bigint"))
    return c.cast(to).alias(name)


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """One raw file in the table's types, with the name of the file each row came from. Types are read
    from the file itself, so files of different months may disagree; a value that doesn't fit stops the
    load."""
    df = spark.read.parquet(path)
    have = {c.lower(): (c, t) for c, t in df.dtypes}
    return df.select(*[_field(c, t, have) for c, t in SOURCE], F.col("_metadata.file_name").alias("_source_filename"))


def with_load(rows: DataFrame, batch_id: str | None = None, loaded_by: str = "cabstrata") -> DataFrame:
    return rows.select("*", F.lit(batch_id or uuid.uuid4().hex).alias("_ingest_batch_id"), F.lit(loaded_by).alias("_loaded_by"), F.current_timestamp().alias("_loaded_at"))


def empty_bronze(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in [*SOURCE, *LOADED]))


def _missing_or_broken(e: Exception) -> bool:
    """Whether the failure is one of the file, not of the query."""
    if isinstance(e, AnalysisException):
        return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
    return any(x in str(e) for x in ("not a Parquet file", "CANNOT_READ_FILE_FOOTER", "FAILED_READ_FILE"))


def union_files(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def read_all(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All files of the list, each by its own types. A missing or broken one is an error, raised before
    anything is written."""
    if not paths:
        raise FileNotFoundError("no files to read")
    return union_files([read_file(spark, p) for p in paths])


def read_present(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """What can be read of the list, and (path, reason) of every file that is missing or broken. None at
    all is an error."""
    frames, skipped = [], []
    for p in paths:
        try:
            frames.append(read_file(spark, p))
        except Exception as e:
            if not _missing_or_broken(e):
                raise
            skipped.append((p, str(e).splitlines()[0]))
    if not frames:
        raise FileNotFoundError(f"none of {len(paths)} files can be read: {skipped}")
    return union_files(frames), skipped


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone table from CSV with declared types."""
    return spark.read.schema(ZONES).option("header", True).csv(path)
