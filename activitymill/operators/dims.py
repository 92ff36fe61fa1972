"""Dimensions: one row per key, with the attributes seen last.

The pick is fixed: the latest time, and at equal times the greater text. All steps here aggregate within each task
before the shuffle, so a key holding a third of all rows leaves a task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitymill.functions.names import repo_owner
from activitymill.functions.time import key_date


def sightings(events: DataFrame, key: str, attributes: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per (by, key, attributes) with the last time seen and the number of events.

    ``events`` is fact_events, or earlier sightings to be merged. Sightings of separate days add up, and dimensions
    and counts can be built from them as from the events themselves.
    """
    merged = "last_seen" in events.columns
    count = F.sum("event_count") if merged else F.count("*")
    return events.groupBy(*by, key, *attributes).agg(
        F.max("last_seen" if merged else "created_ts").alias("last_seen"),
        count.alias("event_count"),
    )


def latest(events: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """One row per key with the attributes seen last, from fact_events or sightings. A null key stays.

    Events are first hashed down to one row per key and attributes: comparing text takes a sort, which so sees the
    different names of a key and not its events.
    """
    seen = events if "last_seen" in events.columns else sightings(events, key, attributes)
    newest = F.max(F.struct("last_seen", *attributes)).alias("newest")
    return seen.groupBy(key).agg(newest).select(key, *[F.col(f"newest.{a}").alias(a) for a in attributes])


def dim_actor(events: DataFrame) -> DataFrame:
    """Actors with their latest login, from fact_events or sightings."""
    return latest(events, "actor_id", ["actor_login"])


def dim_org(events: DataFrame) -> DataFrame:
    """Organisations with their latest login; events without one are left out."""
    return latest(events.filter(F.col("org_id").isNotNull()), "org_id", ["org_login"])


def dim_repo(events: DataFrame) -> DataFrame:
    """Repositories with their latest name and its owner part."""
    return latest(events, "repo_id", ["repo_name"]).withColumn("repo_owner", repo_owner(F.col("repo_name")))


def dim_time(events: DataFrame) -> DataFrame:
    """One row per day seen, at date grain. Every part follows from the key, so only the key is read."""
    day = key_date(F.col("date_key"))
    return events.select("date_key").distinct().withColumns({
        "date": day, "year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day),
        "day_of_week": F.dayofweek(day),  # Sunday is 1
    })
