"""Date expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last day a nanosecond timestamp can hold; text outside does not parse.
PARSEABLE = (dt.date(1677, 9, 22), dt.date(2262, 4, 11))


def parse_day(text: Column) -> Column:
    """Strict year-month-day text to date; anything else, also `99999-01-01`, becomes null."""
    day = F.try_to_timestamp(text, F.lit("yyyy-M-d")).cast("date")
    shaped = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    return F.when(shaped & day.between(*map(F.lit, PARSEABLE)), day)


def days_between(start: Column, end: Column) -> Column:
    """Whole days from `start` to `end`; null if either is."""
    return F.datediff(end, start)


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def date_key(day: Column) -> Column:
    """Day as a YYYYMMDD integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def outside(day: Column, earliest: dt.date, latest: dt.date) -> Column:
    """A known day outside [earliest, latest]."""
    return F.coalesce((day < F.lit(earliest)) | (day > F.lit(latest)), F.lit(False))


def hours_between(start: Column, end: Column) -> Column:
    """Whole-second difference in hours, two places."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.round(seconds / F.lit(3600), 2)
