"""The raw record contract and the tables built from it."""

from __future__ import annotations

# The declared fields of a raw record. Anything else in a line is dropped by the reader.
RAW_SCHEMA = (
    "id STRING, type STRING, created_at STRING, "
    "actor STRUCT<id: BIGINT, login: STRING>, "
    "repo STRUCT<id: BIGINT, name: STRING>, "
    "org STRUCT<id: BIGINT, login: STRING>, "
    "payload STRUCT<action: STRING, commits: ARRAY<STRUCT<sha: STRING, message: STRING>>>"
)
BAD_LINE = "bad_line"  # text of a line that does not fit the contract

# Where the columns of an event, and of a commit within it, come from.
EVENT_FIELDS = {
    "event_id": "id", "event_type": "type",
    "actor_id": "actor.id", "actor_login": "actor.login",
    "repo_id": "repo.id", "repo_name": "repo.name",
    "org_id": "org.id", "org_login": "org.login",
    "action": "payload.action",
}
COMMIT_FIELDS = {"commit_sha": "commit.sha", "commit_message": "commit.message"}

# The event types that are kept.
PUSH = "PushEvent"
PULL_REQUEST = "PullRequestEvent"
ISSUES = "IssuesEvent"
WATCH = "WatchEvent"
TARGET_TYPES = (PUSH, PULL_REQUEST, ISSUES, WATCH)

# An hourly landing file below this size is an error page, not data.
MIN_HOUR_BYTES = 1024

# Output tables with their columns in order.
TABLES = {
    "fact_events": (
        "event_id STRING, event_type STRING, actor_id BIGINT, actor_login STRING, repo_id BIGINT, repo_name STRING, "
        "org_id BIGINT, org_login STRING, action STRING, created_ts TIMESTAMP, date_key INT"
    ),
    "fact_commits": (
        "event_id STRING, actor_id BIGINT, repo_id BIGINT, date_key INT, commit_sha STRING, commit_message STRING"
    ),
    "dim_actor": "actor_id BIGINT, actor_login STRING",
    "dim_repo": "repo_id BIGINT, repo_name STRING, repo_owner STRING",
    "dim_org": "org_id BIGINT, org_login STRING",
    "dim_time": "date_key INT, date DATE, year INT, month INT, day INT, day_of_week INT",
    "events_by_type_per_day": "date_key INT, event_type STRING, event_count BIGINT",
    "events_per_repo_per_day": (
        "date_key INT, repo_id BIGINT, repo_name STRING, repo_owner STRING, event_type STRING, event_count BIGINT"
    ),
    "pr_throughput": "date_key INT, action STRING, pr_count BIGINT",
    "issue_activity": "date_key INT, action STRING, issue_count BIGINT",
    "top_contributors": "actor_id BIGINT, actor_login STRING, event_count BIGINT",
}
FACTS = ("fact_events", "fact_commits")
DIMS = ("dim_actor", "dim_repo", "dim_org", "dim_time")
MARTS = (
    "events_by_type_per_day", "events_per_repo_per_day", "pr_throughput", "issue_activity", "top_contributors",
)


def columns(table: str) -> list[str]:
    return [column.split()[0] for column in TABLES[table].split(", ")]
