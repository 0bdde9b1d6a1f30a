"""Calendar arithmetic that counts boundary crossings, not elapsed units."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def as_of_column(as_of: datetime | str | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def hours_between(start: Column, end: Column) -> Column:
    """Hour boundaries crossed from start to end: 00:59 to 01:01 is 1."""
    return F.floor(F.unix_seconds(end) / 3600) - F.floor(F.unix_seconds(start) / 3600)


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed from start to end."""
    return F.datediff(F.to_date(end), F.to_date(start))


def day_type(date: Column) -> Column:
    # Spark numbers Sunday 1 and Saturday 7.
    return F.when(F.dayofweek(date).isin(1, 7), "weekend").otherwise("weekday")
