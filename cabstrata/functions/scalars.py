"""Scalar expressions whose semantics need care."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(a: Column, b: Column) -> Column:
    """Whole-second boundaries between two naive timestamps."""
    return F.timestamp_diff("SECOND", F.date_trunc("second", a).cast("timestamp_ntz"), F.date_trunc("second", b).cast("timestamp_ntz"))


def minutes_boundary(a: Column, b: Column) -> Column:
    """Minute boundaries crossed: 00:00:50 to 00:01:10 is 1."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", a).cast("timestamp_ntz"), F.date_trunc("minute", b).cast("timestamp_ntz"))


def minutes_fractional(a: Column, b: Column) -> Column:
    """Elapsed minutes with their fraction: 00:00:50 to 00:01:10 is 0.333..."""
    return seconds_between(a, b).cast("double") / F.lit(60.0)


def iso_weekday(c: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(c) + 1


def guarded_ratio(a: Column, b: Column) -> Column:
    """a / b where b is positive, else null."""
    return F.when(b > 0, a / b)


def over(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return a / F.nullif(b, F.lit(0))


def exact(c: Column, digits: int = 4) -> Column:
    """A double as a decimal, so that sums don't depend on their order."""
    return c.cast(f"decimal(18,{digits})")


def exact_sum(c: Column, digits: int = 4) -> Column:
    return F.sum(exact(c, digits)).cast("double")


def exact_avg(c: Column, digits: int = 4) -> Column:
    """The mean of the non-null values, from an exact sum."""
    return exact_sum(c, digits) / F.nullif(F.count(c), F.lit(0)).cast("double")


def rounded(c: Column, digits: int, scale: int = 9) -> Column:
    """Half-up rounding in decimals; rounding doubles depends on their last bit."""
    return F.round(c.cast(f"decimal(30,{scale})"), digits).cast("double")


def bins(c: Column, upper: list[tuple[float, str]], last: str) -> Column:
    """The label of the first right-closed bin that holds c; `last` beyond them and for a null."""
    out = None
    for limit, label in upper:
        out = F.when(c <= limit, label) if out is None else out.when(c <= limit, label)
    return out.otherwise(last)
