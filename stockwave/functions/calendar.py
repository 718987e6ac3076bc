"""Calendar columns of a date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day and month labels, Monday and January first.
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTH_LABELS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def weekday_name(index: Column) -> Column:
    """Label of a weekday number, Monday = 0."""
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), index + 1)


def calendar_columns(date: str | Column = "date") -> list[Column]:
    """Weekday (Monday = 0), month, quarter, day, ISO week and three 0/1 flags."""
    d = F.col(date) if isinstance(date, str) else date
    return [
        F.weekday(d).alias("day_of_week"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.dayofmonth(d).alias("day_of_month"),
        F.weekofyear(d).alias("week_of_year"),
        (F.weekday(d) >= 5).cast("int").alias("is_weekend"),
        (F.dayofmonth(d) == 1).cast("int").alias("is_month_start"),
        (d == F.last_day(d)).cast("int").alias("is_month_end"),
    ]


def onehot_columns(date: str | Column = "date") -> list[Column]:
    """0/1 columns per weekday and month with fixed levels; Monday and January are the base."""
    d = F.col(date) if isinstance(date, str) else date
    days = [(F.weekday(d) == k).cast("int").alias(f"dow_{k}") for k in range(1, 7)]
    months = [(F.month(d) == k).cast("int").alias(f"month_{k}") for k in range(2, 13)]
    return days + months


def is_holiday(date: Column, holidays: Sequence[dt.date]) -> Column:
    """0/1 membership of a date in the holiday list; a null date is not a holiday."""
    if not holidays:
        return F.lit(0)
    return F.coalesce(date.isin(*[F.lit(h) for h in holidays]).cast("int"), F.lit(0))
