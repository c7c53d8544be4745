"""Timestamp expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MILLIS = 86_400_000


def epoch_millis(timestamp: Column) -> Column:
    """Whole milliseconds since the epoch; works for zoned and zone-less timestamps."""
    return F.unix_millis(timestamp.cast("timestamp"))


def days_before(timestamp: Column, days: int) -> Column:
    return timestamp - F.make_dt_interval(F.lit(days))


def within_days(a: Column, b: Column, days: int) -> Column:
    """At most ``days`` apart, compared in whole milliseconds, limit included."""
    return F.abs(epoch_millis(a) - epoch_millis(b)) <= days * DAY_MILLIS


def year_month(timestamp: Column) -> Column:
    """Partition key such as ``202401``."""
    return F.date_format(timestamp, "yyyyMM")
