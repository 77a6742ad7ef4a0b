"""Which days and months a run covers."""

from __future__ import annotations

import calendar
import re
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.functions.calendar import month_number

MONTH = re.compile(r"^(\d{4})-(0[1-9]|1[0-2])$")


def month_list(value: str | Iterable[str] | None) -> list[str]:
    """``YYYY-MM`` months from a list or comma text: first mention kept, bad ones rejected."""
    if value is None:
        return []
    parts = value.split(",") if isinstance(value, str) else [str(v) for v in value]
    months = list(dict.fromkeys(p.strip() for p in parts if p.strip()))
    bad = [m for m in months if not MONTH.match(m)]
    if bad:
        raise ValueError(f"not a YYYY-MM month: {bad}")
    return months


@dataclass(frozen=True)
class Scope:
    """An inclusive run of days."""

    first: date
    last: date

    @classmethod
    def of(cls, first: str, last: str) -> Scope:
        return cls(date.fromisoformat(first), date.fromisoformat(last))

    @classmethod
    def covering(cls, months: str | Iterable[str]) -> Scope:
        """First day of the earliest month to last day of the latest."""
        listed = sorted(month_list(months))
        if not listed:
            raise ValueError("at least one month is needed")
        (y0, m0), (y1, m1) = (map(int, listed[i].split("-")) for i in (0, -1))
        return cls(date(y0, m0, 1), date(y1, m1, calendar.monthrange(y1, m1)[1]))

    @property
    def days(self) -> int:
        """Upper bound on the rows of any table with one row per day of the scope."""
        return (self.last - self.first).days + 1

    @property
    def whole_months(self) -> bool:
        """Does the scope begin with the first and end with the last day of a month?"""
        return self.first.day == 1 and (self.last + timedelta(days=1)).day == 1

    @property
    def months(self) -> list[str]:
        """Every month that the scope touches, as ``YYYY-MM``."""
        first, last = (d.year * 12 + d.month - 1 for d in (self.first, self.last))
        return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, last + 1)]

    def has_day(self, day: Column) -> Column:
        return day.between(F.lit(self.first), F.lit(self.last))

    def has_time(self, moment: Column) -> Column:
        """The same window on a timestamp: a plain range a Parquet scan can skip by."""
        after = self.last + timedelta(days=1)
        return (moment >= F.lit(f"{self.first} 00:00:00").cast("timestamp_ntz")) & (
            moment < F.lit(f"{after} 00:00:00").cast("timestamp_ntz")
        )

    def has_month(self, year: Column, month: Column) -> Column:
        """On partition columns this prunes directories before anything is read."""
        return month_number(year, month).between(
            self.first.year * 100 + self.first.month, self.last.year * 100 + self.last.month
        )

    def outside_day(self, day: Column) -> Column:
        return (day < F.lit(self.first)) | (day > F.lit(self.last))

    def outside_month(self, year: Column, month: Column) -> Column:
        """Year / month pair not among the months the scope touches."""
        spans: dict[int, list[int]] = {}
        y, m = self.first.year, self.first.month
        while (y, m) <= (self.last.year, self.last.month):
            spans.setdefault(y, []).append(m)
            y, m = (y + 1, 1) if m == 12 else (y, m + 1)
        inside = F.lit(False)
        for y, months in spans.items():
            inside = inside | ((year == y) & month.isin(months))
        return ~inside


def in_months(year: Column, month: Column, months: str | Iterable[str]) -> Column:
    """Exactly the listed months, gaps allowed."""
    wanted = [int(m.replace("-", "")) for m in month_list(months)]
    return month_number(year, month).isin(wanted)
