"""Joins whose small side is measured before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a side of a few narrow columns (about 100 bytes a row) is broadcast.
BROADCAST_ROWS = 100_000
SALTS = 16, 256


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Counts at most max_rows + 1 rows. df is executed for it: hand it over materialized."""
    return df.limit(max_rows + 1).count() <= max_rows


def salts_of(df: DataFrame) -> int:
    """As many salts as an eighth of the session's shuffle partitions, at least and at most SALTS: a key with a
    third of all rows is spread in step with the partitions that the session plans for its data. What
    is left uneven beyond that the adaptive skew join splits."""
    planned = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(SALTS[0], min(SALTS[1], planned // 8))


def lookup_join(big: DataFrame, small: DataFrame, keys: list[str], salt_on: list[str], how: str = "inner", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join big with small, a side with at most one row per key.

    Up to max_rows rows small is broadcast. Beyond, both sides are shuffled on the keys and a
    salt taken from the columns salt_on of big, so that a key with a third of all rows is spread
    over as many tasks; small is repeated once per salt. Null keys match nothing. small is executed for its
    size and again for the join: hand over a table that is materialized or cheap.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how: {how}")
    if is_small(small, max_rows):
        return big.join(F.broadcast(small), keys, how)
    salts = salts_of(big)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int")).join(salted, [*keys, "_salt"], how).drop("_salt")
