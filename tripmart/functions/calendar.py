"""Date parts, trip duration and the calendar attributes of a day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minutes_between(start: Column, end: Column) -> Column:
    """Whole seconds between two wall-clock times, in minutes."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Everything the date dimension says about a day; day of week 1 is Sunday."""
    return {
        "year_num": F.year(day),
        "quarter_num": F.quarter(day),
        "month_num": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day_num_in_month": F.dayofmonth(day),
        "day_of_week_num": F.dayofweek(day),
        "day_of_week_name": F.date_format(day, "EEEE"),
        "is_weekend": F.dayofweek(day).isin(1, 7),
    }


def month_number(year: Column, month: Column) -> Column:
    """``yyyyMM`` as one integer: one comparison covers a run of month partitions."""
    return year * 100 + month
