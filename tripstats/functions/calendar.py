"""Dates, months and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def parse_timestamp(text: str | Column, needs_date: bool = False) -> Column:
    """ISO text to timestamp, null when it cannot be read (never raises under ANSI mode).

    `needs_date` refuses text that starts without a date: a bare time of day would otherwise
    silently mean today.
    """
    parsed = F.try_to_timestamp(_col(text))
    if needs_date:
        return F.when(_col(text).rlike(r"^\d{4}-\d{2}-\d{2}"), parsed)
    return parsed


def iso_text(timestamp: str | Column) -> Column:
    """Timestamp as 'yyyy-MM-ddTHH:mm:ss', with fractions of a second if there are any."""
    return F.translate(_col(timestamp).cast("string"), " ", "T")


def month_name(month: str | Column) -> Column:
    """Month number to its English abbreviation; null outside 1..12."""
    number = _col(month)
    first_day = F.make_date(F.lit(2000), number, F.lit(1))
    return F.when(number.between(1, 12), F.date_format(first_day, "MMM"))


def is_weekend(date: str | Column) -> Column:
    """Saturday or Sunday."""
    return F.weekday(_col(date)) >= 5


def date_text(date: str | Column) -> Column:
    """Date as 'yyyy-MM-dd'."""
    return F.date_format(_col(date), "yyyy-MM-dd")


def day_number(date: str | Column) -> Column:
    """Days since 1970-01-01, for range frames over calendar days."""
    return F.unix_date(_col(date).cast("date"))
