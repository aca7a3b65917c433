"""Date columns. The session time zone is UTC."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_day(as_of: date | str | Column | None) -> Column:
    """The reference day of an age or a trailing window; today when none is given."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def epoch_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def epoch_to_iso(seconds: Column) -> Column:
    """ISO-8601 text with the UTC offset, as document fields carry it."""
    stamp = F.date_format(F.timestamp_seconds(F.coalesce(seconds, F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(stamp, F.lit("+00:00"))


def age_days(day: Column, as_of) -> Column:
    return F.datediff(as_day(as_of), F.to_date(day))


def date_parts(day: Column) -> dict[str, Column]:
    """Calendar columns; Sunday is day 1 of the week, weeks are ISO weeks."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "quarter": F.quarter(day),
        "day_of_week": F.dayofweek(day),
        "week_of_year": F.weekofyear(day),
    }
