"""What changed between consecutive full snapshots.

A full outer join on the primary key compares canonical row hashes of a snapshot and the one before:
missing sides are additions and removals, unequal hashes are changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabstrata.functions.keys import TRIP_IDS, TRIP_VALUES, bare_etag, bare_name, filled, row_hash, trip_key
from cabstrata.operators.sizing import lookup_join
from cabstrata.session import materialize


def snapshot_sequence(rows: DataFrame, scope: list[str], order: str) -> DataFrame:
    """(scope, order, _sid, _prev, _next): one row per snapshot, numbered, with the numbers of the one before
    and after it in its scope. The list is written once: it is a pass over these columns only."""
    listed = materialize(rows.select(*scope, order).distinct().withColumn("_sid", F.monotonically_increasing_id()), "snapshots")
    w = Window.partitionBy(*(scope or [F.lit(0)])).orderBy(order)
    return listed.withColumns({"_prev": F.lag("_sid").over(w), "_next": F.lead("_sid").over(w)})


def snapshot_diff(rows: DataFrame, scope: list[str], order: str, key: str, hashed: list[str], prefer: Column) -> DataFrame:
    """(scope, order, key, change) for every snapshot against the one before it in its scope.

    rows: any number of rows per snapshot and key, of which the one with the greatest `prefer` counts;
    hashed are the columns whose values are compared, null equal to null. Rows with a null in scope,
    order or key belong to no snapshot and are left out. The first snapshot of a scope has nothing to
    be compared with. The list of snapshots is broadcast only if its measured size allows it.

    Rows carry the snapshot's number instead of its names, snapshots without a neighbour fall out before
    anything is shuffled, and the folded state is written once, so that the wide columns are read and folded
    once for both sides of the join.
    """
    rows = rows.where(" and ".join(f"`{c}` is not null" for c in [*scope, order, key]))
    h = F.struct(row_hash(hashed, 1).alias("a"), row_hash(hashed, 2).alias("b"))
    seq = snapshot_sequence(rows, scope, order)
    slim = rows.select(key, *scope, order, F.struct(prefer.alias("p"), h.alias("h")).alias("_r"))
    placed = lookup_join(slim, seq.where("_prev is not null or _next is not null"), [*scope, order], salt_on=[key])
    folded = placed.groupBy(key, "_sid").agg(F.max("_r").getField("h").alias("h"), F.first("_prev").alias("_prev"), F.first("_next").alias("_next"))
    one = materialize(folded, "snapshot-state")
    now = one.where("_prev is not null").select(key, "_sid", F.col("h").alias("_now"))
    old = one.where("_next is not null").select(key, F.col("_next").alias("_sid"), F.col("h").alias("_old"))
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_now").isNull(), "removed").when(F.col("_old") != F.col("_now"), "changed")
    changed = now.join(old, [key, "_sid"], "full_outer").withColumn("change", change).where("change is not null")
    return lookup_join(changed, seq.select(*scope, order, "_sid"), ["_sid"], salt_on=[key]).select(key, *scope, order, "change")


def file_changes(fingerprints: DataFrame) -> DataFrame:
    """Files added, removed and changed between consecutive snapshots of the state table. Of several
    rows of a file in one snapshot the one recorded last counts (then the greatest etag)."""
    rows = fingerprints.select("snapshot_id", bare_name(F.col("filename")).alias("item"), bare_etag(F.col("etag")).alias("etag"), "recorded_at")
    d = snapshot_diff(rows, [], "snapshot_id", "item", ["etag"], F.struct("recorded_at", "etag"))
    return d.select(F.lit("file").alias("entity"), "item", F.col("snapshot_id").cast("string").alias("delivery"), "change")


def delivery_changes(bronze: DataFrame) -> DataFrame:
    """Trips added, removed and changed between consecutive full deliveries of a file. Of several rows
    of a trip in one delivery the last loaded counts, then the fullest, then the smallest _row_id."""
    rows = bronze.select(
        bare_name(F.col("_source_filename")).alias("_file"), F.col("_ingest_batch_id").alias("delivery"), F.unhex(trip_key()).alias("_trip"),
        "_loaded_at", filled([*TRIP_IDS, *TRIP_VALUES]).alias("_filled"), (-F.col("_row_id")).alias("_id"), *TRIP_VALUES,
    )
    d = snapshot_diff(rows, ["_file"], "delivery", "_trip", TRIP_VALUES, F.struct("_loaded_at", "_filled", "_id"))
    return d.select(F.lit("trip").alias("entity"), F.lower(F.hex("_trip")).alias("item"), "delivery", "change")
