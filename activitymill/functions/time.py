"""Instants, UTC days and date keys. None of them depends on the session time zone for text that carries a zone."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_instant(text: Column) -> Column:
    """Parse ISO-8601 text to an instant; bad text gives null, text without a zone is read as UTC.

    Text without a date is bad: a bare time would become one of the day of the run.
    """
    text = F.when(text.rlike(r"^\s*[+-]?\d{4}"), text)
    return F.when(text.endswith("Z"), F.try_to_timestamp(text)).otherwise(
        F.coalesce(F.try_to_timestamp(F.concat(text, F.lit("Z"))), F.try_to_timestamp(text))
    )


def utc_day(instant: Column) -> Column:
    """Calendar date of an instant in UTC."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


def date_key(day: Column) -> Column:
    """Date to its yyyyMMdd integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def key_date(key: Column) -> Column:
    """yyyyMMdd integer back to its date."""
    return F.make_date(
        F.floor(key / 10000).cast("int"), F.floor(key / 100).cast("int") % 100, key % 100
    )


def utc_wall_clock(instant: Column) -> Column:
    """Instant to the zone-less timestamp a UTC clock shows."""
    seconds = (F.unix_micros(instant) / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def parse_day(text: str) -> date:
    """Run date as 20240602 or 2024-06-02."""
    return datetime.strptime(text.replace("-", ""), "%Y%m%d").date()


def day_key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day
