"""Fact tables from raw records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activitymill.contract import COMMIT_FIELDS, EVENT_FIELDS, PUSH, TARGET_TYPES, columns
from activitymill.functions.time import date_key, event_instant, utc_day


def target_events(raw: DataFrame) -> DataFrame:
    """Raw records of the four kept types; a null type is dropped."""
    return raw.filter(F.col("type").isin(*TARGET_TYPES))


def flatten(raw: DataFrame, *more: str | Column) -> DataFrame:
    """Raw records with their nested fields as columns, the parsed time and the day; ``more`` is carried along."""
    flat = raw.select(*_fields(EVENT_FIELDS), "created_at", *more)
    # One column per step, so that the text is parsed once and not once per date part.
    return (
        flat.withColumn("created_ts", event_instant(F.col("created_at")))
        .withColumn("utc_day", utc_day(F.col("created_ts")))
        .withColumn("date_key", date_key(F.col("utc_day")))
        .drop("created_at", "utc_day")
    )


def fact_events(raw: DataFrame) -> DataFrame:
    """One row per event of a kept type."""
    return flatten(target_events(raw)).select(*columns("fact_events"))


def fact_commits(raw: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per commit of a push; a push without commits gives no row unless ``keep_empty``."""
    pushes = flatten(raw.filter(F.col("type") == PUSH), F.col("payload.commits").alias("commits"))
    return explode_commits(pushes, keep_empty=keep_empty)


def explode_commits(pushes: DataFrame, *more: str, keep_empty: bool = False) -> DataFrame:
    """Commit rows from flat pushes that carry ``commits``; the day was worked out once per push.

    With ``keep_empty`` a push without commits gives one row without a commit.
    """
    parent = ["event_id", "actor_id", "repo_id", "date_key"]
    explode = F.explode_outer if keep_empty else F.explode
    commits = pushes.select(*parent, *more, explode("commits").alias("commit"))
    return commits.select(*parent, *_fields(COMMIT_FIELDS), *more)


def _fields(names: Mapping[str, str]) -> list[Column]:
    return [F.col(field).alias(name) for name, field in names.items()]
