"""Days and instants against Python's own calendar, under a session zone that is not UTC."""

import random
from datetime import datetime, timedelta, timezone

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from activitymill.functions.time import (
    date_key, day_key, event_instant, key_date, parse_day, utc_day, utc_wall_clock,
)

EPOCH = datetime(1970, 1, 1)


def test_days_of_random_instants(spark):
    r = random.Random(3)
    seconds = [r.randint(-60_000_000_000, 250_000_000_000) for _ in range(3000)] + [-1, 0, 86399, 86400, -86400]
    df = spark.createDataFrame([(s,) for s in seconds], "s BIGINT").withColumn("ts", F.timestamp_seconds("s"))
    df = df.withColumn("key", date_key(utc_day(F.col("ts"))))
    got = df.select("s", "key", key_date(F.col("key")).cast("string"), utc_wall_clock(F.col("ts"))).collect()
    for s, key, day, clock in got:
        want = EPOCH + timedelta(seconds=s)
        assert (key, day, clock) == (day_key(want.date()), want.date().isoformat(), want)


def test_texts_of_instants(spark):
    texts = {
        "2024-06-02T14:00:00Z": "2024-06-02 14:00:00",
        "2024-06-02T14:00:00.123456Z": "2024-06-02 14:00:00.123456",
        "2024-06-02 14:00:00": "2024-06-02 14:00:00",
        "2024-06-02T14:00:00+05:30": "2024-06-02 08:30:00",
        "2024-03-10T02:30:00": "2024-03-10 02:30:00",  # an hour that the session's zone skips
        "": None, "Z": None, "2024-13-01T00:00:00Z": None, "2024-02-30T00:00:00Z": None, "junk": None,
    }
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t STRING")
    got = df.select("t", utc_wall_clock(event_instant(F.col("t"))).cast("string")).collect()
    assert {t: v for t, v in got} == texts | {None: None}


@settings(deadline=None, max_examples=200)
@given(st.datetimes(min_value=datetime(1, 1, 1), timezones=st.just(timezone.utc)))
def test_run_dates_are_read_in_both_forms(moment):
    day = moment.date()
    assert parse_day(day.isoformat()) == parse_day(f"{day.year:04d}{day.month:02d}{day.day:02d}") == day
