"""Calendar expressions on date columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | date | Column | None) -> Column:
    """A date expression; ``None`` is the current date."""
    if value is None:
        return F.current_date()
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def week_start(day: Column) -> Column:
    """The Monday of the week."""
    return F.trunc(day, "week")


def day_of_week(day: Column) -> Column:
    """Sunday is 0, Saturday 6."""
    return F.dayofweek(day) - 1
