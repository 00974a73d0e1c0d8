"""Row keys and row hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The columns of a raw trip record.
TRIP_IDS = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID"]
TRIP_VALUES = [
    "passenger_count", "trip_distance", "RatecodeID", "store_and_fwd_flag", "payment_type", "fare_amount", "extra",
    "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge",
    "airport_fee", "cbd_congestion_fee",
]
NULL_TEXT = "_null_"


def second_text(c: Column) -> Column:
    """yyyy-MM-dd HH:mm:ss of a naive timestamp, without a time zone's help."""
    return F.substring(c.cast("string"), 1, 19)


def surrogate_key(*cols: Column, null_text: str = NULL_TEXT) -> Column:
    """md5 in hex of the texts of cols joined by '-'; a null is null_text, so the key is never null."""
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit(null_text)) for c in cols]))


def trip_key(vendor: str = "VendorID", pickup: str = "tpep_pickup_datetime", dropoff: str = "tpep_dropoff_datetime", pu: str = "PULocationID", do: str = "DOLocationID") -> Column:
    return surrogate_key(F.col(vendor), second_text(F.col(pickup)), second_text(F.col(dropoff)), F.col(pu), F.col(do))


def null_places(cols: list[str]) -> Column:
    """The places of nulls among cols, one bit each."""
    if len(cols) > 63:
        return F.struct(*[null_places(cols[i : i + 63]) for i in range(0, len(cols), 63)])
    return sum((F.when(F.col(c).isNull(), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, c in enumerate(cols)), F.lit(0).cast("bigint"))


def row_hash(cols: list[str], seed: int = 0) -> Column:
    """64-bit hash of a row in which a null at one place differs from a null at another.

    The built-in hash passes over nulls; the places of nulls go in as well.
    """
    return F.xxhash64(F.lit(seed), null_places(cols), *[F.col(c) for c in cols])


def filled(cols: list[str]) -> Column:
    """How many of cols aren't null."""
    return sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))


def bare_name(c: Column) -> Column:
    """A file's name without directory, outer blanks and letter case."""
    return F.lower(F.trim(F.substring_index(F.substring_index(c, "/", -1), "\\", -1)))


def bare_etag(c: Column) -> Column:
    """An etag without weak mark, quotes, outer blanks and letter case."""
    return F.lower(F.trim(F.replace(F.regexp_replace(F.trim(c), r"^[wW]/", ""), F.lit('"'), F.lit(""))))
