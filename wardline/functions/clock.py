"""Time expressions. All times are ``timestamp_ntz``; the session zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_YEAR = 60.0 * 60.0 * 24.0 * 365.242


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def nearest_hour(ts: Column) -> Column:
    return hour_of(ts + F.expr("INTERVAL 30 MINUTES"))


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def hours_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(3_600_000_000.0)


def years_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(1_000_000.0 * SECONDS_PER_YEAR)


def day_of(ts: Column) -> Column:
    return ts.cast("date")


def days_covering(start: Column, end: Column) -> Column:
    """Every calendar day touched by [start, end]; call only where start <= end."""
    return F.sequence(day_of(start), day_of(end), F.expr("INTERVAL 1 DAY"))


def hour_number(ts: Column) -> Column:
    """Whole hours since 1970-01-01, a dense integer step index."""
    return F.floor(micros(ts) / F.lit(3_600_000_000)).cast("long")


def parse_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; blank text becomes null."""
    return F.to_timestamp_ntz(F.nullif(F.trim(text), F.lit("")), F.lit("yyyy-MM-dd HH:mm:ss"))
