"""Histories of changing attributes from periodic readings.

Every attribute has its own change log (an event wherever its value differs from the reading before)
and so its own intervals. The histories are combined by splitting at the union of all boundaries and
coalescing neighbours that say the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_reading(readings: DataFrame, entity: str, at: str, attributes: list[str], prefer: list[Column]) -> DataFrame:
    """One row per entity and time: the one with the greatest `prefer`, then the greatest values. The
    fold is partial on the map side: afterwards an entity has at most one row per run."""
    pick = F.max(F.struct(*[c.alias(f"p{i}") for i, c in enumerate(prefer)], F.struct(*attributes).alias("v"))).getField("v")
    return readings.where(F.col(entity).isNotNull() & F.col(at).isNotNull()).groupBy(entity, at).agg(pick.alias("_v")).select(entity, at, "_v.*")


def change_events(readings: DataFrame, entity: str, at: str, attributes: list[str]) -> DataFrame:
    """Adds `<attribute>_event` to one reading per time: a struct with the value where the attribute
    begins to have it, else null. Null equals null and is a value like any other."""
    w = Window.partitionBy(entity).orderBy(at)
    first = F.row_number().over(w) == 1
    return readings.select(entity, at, *[F.when(first | ~F.col(a).eqNullSafe(F.lag(a).over(w)), F.struct(F.col(a).alias("v"))).alias(f"{a}_event") for a in attributes])


def attribute_history(readings: DataFrame, entity: str, at: str, attribute: str, prefer: list[Column]) -> DataFrame:
    """(entity, attribute, value, valid_from, valid_to) of a single attribute; valid_to is null while open."""
    e = change_events(one_reading(readings, entity, at, [attribute], prefer), entity, at, [attribute]).where(f"{attribute}_event is not null")
    w = Window.partitionBy(entity).orderBy(at)
    return e.select(entity, F.lit(attribute).alias("attribute"), F.col(f"{attribute}_event.v").alias("value"), F.col(at).alias("valid_from"), F.lead(at).over(w).alias("valid_to"))


def combined_history(readings: DataFrame, entity: str, at: str, attributes: list[str], prefer: list[Column]) -> DataFrame:
    """(entity, attributes, valid_from, valid_to, versions): the attributes' own histories, split at the
    union of their boundaries and coalesced. versions is the entity's number of versions.

    Readings without entity or time are left out; a missing reading changes nothing; an empty input
    gives no rows. Extra columns are never read. All windows share one clustering on the entity.
    """
    events = change_events(one_reading(readings, entity, at, attributes, prefer), entity, at, attributes)
    split = events.where(" or ".join(f"{a}_event is not null" for a in attributes))
    w = Window.partitionBy(entity).orderBy(at)
    carried = split.select(entity, at, *[F.last(f"{a}_event", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(a) for a in attributes])
    values = F.struct(*attributes)
    coalesced = carried.withColumn("_same", values.eqNullSafe(F.lag(values).over(w))).where(~F.col("_same"))
    whole = Window.partitionBy(entity)
    return coalesced.select(entity, *[F.col(f"{a}.v").alias(a) for a in attributes], F.col(at).alias("valid_from"), F.lead(at).over(w).alias("valid_to"), F.count(F.lit(1)).over(whole).alias("versions"))


def combine_histories(histories: dict[str, DataFrame], entity: str) -> DataFrame:
    """(entity, attributes, valid_from, valid_to): histories of attributes from different sources as one.

    histories: attribute -> (entity, value, valid_from, valid_to) as attribute_history gives it, valid_to null
    while open; each has its own times, may begin later than another and may end. Time is split at the
    union of all boundaries; an attribute is null where its history says nothing; neighbours that say the
    same in all attributes are coalesced, and time before the first or without any value beside nulls is
    part of a version like any other. Versions of no length vanish. Null entities and versions without a
    beginning are left out; no histories' rows give no rows. Every version is two events, so the
    histories meet in one grouping on entity and time and share its clustering in the windows.
    """
    parts = None
    for k, (attribute, h) in enumerate(histories.items()):
        known = h.where(F.col(entity).isNotNull() & F.col("valid_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))))
        begin = F.struct(F.col("valid_from").alias("at"), F.lit(True).alias("on"), F.col("value").alias("v"))
        end = F.struct(F.col("valid_to").alias("at"), F.lit(False).alias("on"), F.nullif(F.col("value"), F.col("value")).alias("v"))
        e = known.select(entity, F.explode(F.array(begin, end)).alias("_event")).where("_event.at is not null")
        e = e.select(entity, F.col("_event.at").alias("_at"), F.struct("_event.on", "_event.v").alias(f"_e{k}"))
        parts = e if parts is None else parts.unionByName(e, allowMissingColumns=True)
    names = list(histories)
    met = parts.groupBy(entity, "_at").agg(*[F.max(f"_e{k}").alias(f"_e{k}") for k in range(len(names))])  # a beginning wins over an end
    w = Window.partitionBy(entity).orderBy("_at")
    carried = met.select(entity, "_at", *[F.last(f"_e{k}", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).getField("v").alias(a) for k, a in enumerate(names)])
    values = F.struct(*names)
    coalesced = carried.withColumn("_same", values.eqNullSafe(F.lag(values).over(w))).where(~F.col("_same"))
    return coalesced.select(entity, *names, F.col("_at").alias("valid_from"), F.lead("_at").over(w).alias("valid_to"))
