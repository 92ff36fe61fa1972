"""Activity counts. Each takes fact_events, or counts of it that carry ``event_count``.

Where a dimension supplies a name, rows are counted first and joined after: the join sees one row per group, so a
key holding a third of all events is one row per group too. Keys of a dimension are unique (checked before
publishing), so this equals joining first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activitymill.contract import ISSUES, PULL_REQUEST, columns


def _count(events: DataFrame) -> Column:
    return F.sum("event_count") if "event_count" in events.columns else F.count("*")


def grouped_count(events: DataFrame, keys: Sequence[str], name: str = "event_count") -> DataFrame:
    """Rows per key combination; null keys form a group."""
    return events.groupBy(*keys).agg(_count(events).alias(name))


def events_by_type_per_day(events: DataFrame) -> DataFrame:
    return grouped_count(events, ["date_key", "event_type"])


def events_per_repo_per_day(events: DataFrame, dim_repo: DataFrame) -> DataFrame:
    """Events per day, repository and type, with the repository's name; an unknown repository has none."""
    names = dim_repo.select("repo_id", "repo_name", "repo_owner")
    counted = grouped_count(events, ["date_key", "repo_id", "event_type"])
    return counted.join(names, "repo_id", "left").select(*columns("events_per_repo_per_day"))


def pr_throughput(events: DataFrame) -> DataFrame:
    """Pull-request events per day and action; a missing action is a group of its own."""
    return grouped_count(events.filter(F.col("event_type") == PULL_REQUEST), ["date_key", "action"], "pr_count")


def issue_activity(events: DataFrame) -> DataFrame:
    """Issue events per day and action; a missing action is a group of its own."""
    return grouped_count(events.filter(F.col("event_type") == ISSUES), ["date_key", "action"], "issue_count")


def top_contributors(events: DataFrame, dim_actor: DataFrame) -> DataFrame:
    """Events per actor, with the login: all actors, unordered."""
    counted = grouped_count(events, ["actor_id"])
    return counted.join(dim_actor.select("actor_id", "actor_login"), "actor_id", "left").select(
        *columns("top_contributors")
    )
