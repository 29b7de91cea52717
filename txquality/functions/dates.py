"""Timestamps, calendar parts and day counts (session zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def timestamp_or_null(name: str) -> Column:
    """Text as timestamp; what does not parse becomes NULL instead of an error."""
    return F.try_to_timestamp(F.col(name))


def partition_parts(name: str) -> dict[str, Column]:
    return {
        "partition_year": F.year(name),
        "partition_month": F.month(name),
        "partition_day": F.dayofmonth(name),
    }


def day_start(name: str) -> Column:
    return F.date_trunc("day", F.col(name))


def month_start(name: str) -> Column:
    return F.date_trunc("month", F.col(name))


def calendar_days(start: str, end: str) -> Column:
    """Midnights passed from ``start`` to ``end``; may be negative or NULL."""
    return F.datediff(F.col(end), F.col(start))


def calendar_date(name: str) -> Column:
    """Date of a timestamp text, NULL where it does not parse."""
    return F.to_date(timestamp_or_null(name))
