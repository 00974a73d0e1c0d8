"""Data tests: each returns the offending rows (or keys), so an empty result is a pass."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabstrata.functions.scalars import over


# Conditions on single rows: one pass over a table answers all of them (see run_checks).


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_unaccepted(column: str, values: list) -> Column:
    """Another value; null passes."""
    return ~F.col(column).isin(values)


def is_outside(column: str, low=None, high=None) -> Column:
    """Outside [low, high]; null passes."""
    c = F.col(column)
    bad = [c < low] if low is not None else []
    bad += [c > high] if high is not None else []
    return reduce(lambda a, b: a | b, bad, F.lit(False))


def is_insane_duration(column: str, most: float) -> Column:
    """Null, not positive or above `most`."""
    c = F.col(column)
    return c.isNull() | (c <= 0) | (c > most)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_missing(column))


def unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """(columns, n) of every combination that stands more than once; combinations with a null are left out."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.where(known).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(is_unaccepted(column, values))


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null value has no partner."""
    p = parent.select(F.col(key).alias("_pk")).where("_pk is not null").distinct()
    return child.where(F.col(column).isNotNull()).join(p, F.col(column) == F.col("_pk"), "left_anti")


def in_range(df: DataFrame, column: str, low=None, high=None, only: str = "true") -> DataFrame:
    """Rows of those that satisfy `only` whose value lies outside [low, high]."""
    return df.where(F.expr(only)).where(is_outside(column, low, high))


def duration_sane(df: DataFrame, column: str, most: float, only: str = "true") -> DataFrame:
    return df.where(F.expr(only)).where(is_insane_duration(column, most))


def period_counts(df: DataFrame, period: list[str], tolerance: float = 0.4, least: int = 10_000, weight: str | None = None) -> DataFrame:
    """Periods whose number of rows (or sum of weight, in a table of counts) differs from the one before
    by more than tolerance, where both have at least `least` rows."""
    n = df.groupBy(*period).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("trip_count"))
    p = n.withColumn("prev_trip_count", F.lag("trip_count").over(Window.partitionBy(F.lit(0)).orderBy(*period)))
    change = over(F.abs(F.col("trip_count") - F.col("prev_trip_count")).cast("double"), F.col("prev_trip_count").cast("double"))
    return p.where((F.col("trip_count") >= least) & (F.col("prev_trip_count") >= least)).withColumn("pct_change", change).where(F.col("pct_change") > tolerance)


def one_current(history: DataFrame, key: str) -> DataFrame:
    """Keys with more than one open version."""
    return unique(history.where("valid_to is null"), [key])


def reconcile(fact: DataFrame, mart: DataFrame, period: list[str], name: str) -> DataFrame:
    """Periods in which the mart's trips don't add up to the fact's rows."""
    f = fact.groupBy(*period).agg(F.count(F.lit(1)).alias("fact_count"))
    m = mart.groupBy(*period).agg(F.sum("trip_count").alias("mart_count"))
    j = f.join(m, period, "left").withColumn("mart_count", F.coalesce("mart_count", F.lit(0).cast("bigint")))
    return j.where("mart_count != fact_count").select(F.lit(name).alias("mart"), *period, "fact_count", "mart_count", (F.col("fact_count") - F.col("mart_count")).alias("diff"))


def reconcile_all(fact: DataFrame, marts: dict[str, DataFrame], period: list[str]) -> DataFrame:
    """Months in which any of the marts doesn't add up to the facts: what is still to be built again."""
    return reduce(lambda a, b: a.unionByName(b), [reconcile(fact, m, period, name) for name, m in marts.items()])


def freshness(df: DataFrame, column: str, now: str, warn_days: int = 45, error_days: int = 75) -> DataFrame:
    """One row: the last load, its age in days at `now` (a timestamp text), and pass, warn or error. A
    table without a load time is an error."""
    age = F.date_diff(F.to_date(F.lit(now)), F.to_date("last_loaded"))
    status = F.when(age.isNull() | (age > error_days), "error").when(age > warn_days, "warn").otherwise("pass")
    return df.agg(F.max(column).alias("last_loaded")).select("last_loaded", age.alias("age_days"), status.alias("status"))


@dataclass(frozen=True)
class Check:
    """A named test; severity is error (stops a build) or warn (is reported)."""

    name: str
    run: object
    severity: str = "error"


@dataclass(frozen=True)
class RowCheck:
    """A named test of single rows of a table: bad is the condition that none may satisfy."""

    name: str
    table: str
    bad: Column
    severity: str = "error"


def run_checks(checks: list[Check | RowCheck], tables: dict[str, DataFrame]) -> list[tuple[str, str, int]]:
    """(name, severity, offending rows) of the checks that found any, errors first. The row checks of a
    table are counted in one pass over it."""
    found = [(c.name, c.severity, c.run(tables).count()) for c in checks if isinstance(c, Check)]
    by_table: dict[str, list[RowCheck]] = {}
    for c in checks:
        if isinstance(c, RowCheck):
            by_table.setdefault(c.table, []).append(c)
    for t, own in by_table.items():
        n = tables[t].agg(*[F.count_if(F.coalesce(c.bad, F.lit(False))).alias(f"n{i}") for i, c in enumerate(own)]).head()
        found += [(c.name, c.severity, n[i]) for i, c in enumerate(own)]
    return sorted([f for f in found if f[2]], key=lambda f: (f[1] != "error", f[0]))
