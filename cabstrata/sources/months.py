"""Months as data: parsing, years, and the month that a run is for."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date

FIRST_YEAR = 2009


@dataclass(frozen=True, order=True)
class Month:
    year: int
    month: int

    def __post_init__(self):
        if not (1 <= self.year <= 9999 and 1 <= self.month <= 12):
            raise ValueError(f"no month: {self.year}-{self.month}")

    def __str__(self) -> str:
        return f"{self.year:04d}-{self.month:02d}"

    @property
    def filename(self) -> str:
        return f"yellow_tripdata_{self}.parquet"

    def plus(self, months: int) -> Month:
        n = self.year * 12 + self.month - 1 + months
        return Month(n // 12, n % 12 + 1)


def months_of_year(year: int) -> list[Month]:
    first = Month(year, 1)
    return [first.plus(i) for i in range(12)]


def parse_months(text: str) -> list[Month]:
    """'2023', '2023-01' or a list of both with commas, in the given order, each month once."""
    out: list[Month] = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        if re.fullmatch(r"\d{4}", part):
            out += months_of_year(int(part))
        elif m := re.fullmatch(r"(\d{4})-(\d{2})", part):
            out.append(Month(int(m[1]), int(m[2])))
        else:
            raise ValueError(f"no month or year: {part}")
    if not out or min(out).year < FIRST_YEAR:
        raise ValueError(f"months from {FIRST_YEAR} on are needed")
    return list(dict.fromkeys(out))


def months_between(first: str, last: str) -> list[Month]:
    """All months from first to last, both included, in order."""
    (a,), (b,) = parse_months(first), parse_months(last)
    return [a.plus(i) for i in range((b.year - a.year) * 12 + b.month - a.month + 1)]


def target_month(today: date, year: int | None = None, month: int | None = None, interval_start: date | None = None, lag_months: int = 2) -> Month:
    """The month that a run is for: the one asked for, else that of a backfill's interval, else today's
    minus the lag. Never later than the lag allows: data of later months can't be there yet."""
    if not 0 <= lag_months <= 12:
        raise ValueError("lag_months: 0 to 12")
    if (year is None) != (month is None):
        raise ValueError("year and month go together")
    latest = Month(today.year, today.month).plus(-lag_months)
    if year is not None:
        asked = Month(year, month)
        if asked > latest:
            raise ValueError(f"{asked} isn't published before {asked.plus(lag_months)}")
        return asked
    return min(latest, Month(interval_start.year, interval_start.month)) if interval_start else latest
