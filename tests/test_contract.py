"""One hand-made line per case that the raw contract allows, with the exact rows it must give."""

import json

import pytest
from pyspark.sql import functions as F

from activitymill.functions.time import utc_wall_clock
from activitymill.operators import dims, facts, marts, profiles
from activitymill.sources.landing import scan_events
from tests.conftest import rows

BIG = 9_999_999_999  # over 32 bits


def line(id="e", type="WatchEvent", at="2024-06-02T14:00:00Z", actor=(1, "ann"), repo=(10, "ann/lib"), org=None,
         action=None, commits=None, **extra):
    record = {"id": id, "type": type, "created_at": at, **extra}
    if actor:
        record["actor"] = {"id": actor[0], "login": actor[1]}
    if repo:
        record["repo"] = {"id": repo[0], "name": repo[1]}
    if org:
        record["org"] = {"id": org[0], "login": org[1]}
    payload = {}
    if action:
        payload["action"] = action
    if commits is not None:
        payload["commits"] = [{"sha": s, "message": m, "author": "dropped"} for s, m in commits]
    record["payload"] = payload
    return json.dumps(record)


LINES = [
    line("push2", "PushEvent", commits=[("a1", "first"), ("a2", "second")]),
    line("push_empty", "PushEvent", commits=[]),
    line("push_none", "PushEvent"),
    line("pr", "PullRequestEvent", action="opened", org=(7, "acme")),
    line("issue", "IssuesEvent", action="closed"),
    line("issue_no_action", "IssuesEvent"),
    line("watch", "WatchEvent", action="started"),
    line("fork", "ForkEvent"),
    line("no_repo", repo=None),
    line("no_actor_id", actor=(None, "ghost")),
    line("big_id", actor=(BIG, "big")),
    line("text_actor_id", actor=("oops", "odd")),
    line(12345, "WatchEvent"),
    line("bad_time", at="yesterday-ish"),
    line("null_time", at=None),
    line("no_slash", repo=(11, "solo")),
    line("renamed_old", actor=(2, "bob"), at="2024-06-02T10:00:00Z"),
    line("renamed_new", actor=(2, "bobby"), at="2024-06-02T11:00:00Z"),
    line("just_after_midnight", at="2024-06-02T00:30:00Z"),
    line("just_before_midnight", at="2024-06-01T23:59:59Z"),
    line("offset", at="2024-06-02T01:00:00+02:00"),
    line("no_zone", at="2024-06-02T00:15:00"),
    line("undeclared", surprise={"deep": 1}),
    '{"id": "broken", "type": "PushEvent", "created_at":',
    "",
    line("twice"),
    line("twice"),
]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("landing") / "2024-06-02-0.json"
    path.write_text("\n".join(LINES) + "\n")
    return scan_events(spark, str(path)).cache()


@pytest.fixture(scope="module")
def events(raw):
    return facts.fact_events(raw).cache()


def one(events, event_id):
    found = events.filter(F.col("event_id") == event_id).withColumn("created_ts", utc_wall_clock(F.col("created_ts")))
    return found.collect()[0].asDict()


def test_every_line_but_the_blank_one_is_read(raw):
    assert raw.count() == len(LINES) - 1
    assert profiles.has_schema(raw)
    assert not profiles.has_schema(raw.drop("org"))


def test_only_target_types_become_events(events):
    ids = [r[0] for r in rows(events, "event_id")]
    assert "fork" not in ids and "broken" not in ids
    assert len(ids) == len(LINES) - 3


def test_full_row(events):
    assert {k: str(v) for k, v in one(events, "pr").items()} == {
        "event_id": "pr", "event_type": "PullRequestEvent", "actor_id": "1", "actor_login": "ann", "repo_id": "10",
        "repo_name": "ann/lib", "org_id": "7", "org_login": "acme", "action": "opened",
        "created_ts": "2024-06-02 14:00:00", "date_key": "20240602",
    }


def test_types(events):
    assert dict(events.dtypes) == {
        "event_id": "string", "event_type": "string", "actor_id": "bigint", "actor_login": "string",
        "repo_id": "bigint", "repo_name": "string", "org_id": "bigint", "org_login": "string", "action": "string",
        "created_ts": "timestamp", "date_key": "int",
    }


@pytest.mark.parametrize("event_id, column, expected", [
    ("watch", "org_id", None),
    ("no_repo", "repo_id", None),
    ("no_repo", "repo_name", None),
    ("no_actor_id", "actor_id", None),
    ("no_actor_id", "actor_login", "ghost"),
    ("big_id", "actor_id", BIG),
    ("text_actor_id", "actor_id", None),
    ("text_actor_id", "repo_id", 10),
    ("12345", "event_type", "WatchEvent"),
    ("push2", "action", None),
    ("bad_time", "created_ts", None),
    ("bad_time", "date_key", None),
    ("null_time", "date_key", None),
    ("just_after_midnight", "date_key", 20240602),
    ("just_before_midnight", "date_key", 20240601),
    ("offset", "date_key", 20240601),
    ("no_zone", "date_key", 20240602),
    ("undeclared", "actor_id", 1),
])
def test_field(events, event_id, column, expected):
    assert one(events, event_id)[column] == expected


def test_repeated_event_is_kept_twice(events):
    assert events.filter("event_id = 'twice'").count() == 2


def test_commits(raw):
    commits = facts.fact_commits(raw)
    assert commits.columns == ["event_id", "actor_id", "repo_id", "date_key", "commit_sha", "commit_message"]
    assert rows(commits) == [
        ("push2", 1, 10, 20240602, "a1", "first"),
        ("push2", 1, 10, 20240602, "a2", "second"),
    ]


def test_an_outer_explode_would_add_rows(raw):
    pushes = raw.filter("type = 'PushEvent'")
    assert pushes.select(F.explode("payload.commits")).count() == 2
    assert pushes.select(F.explode_outer("payload.commits")).count() == 4


def test_dim_actor_takes_the_latest_login_and_keeps_a_null_key(events):
    assert rows(dims.dim_actor(events)) == [(None, "odd"), (1, "ann"), (2, "bobby"), (BIG, "big")]


def test_dim_repo(events):
    assert rows(dims.dim_repo(events)) == [(None, None, None), (10, "ann/lib", "ann"), (11, "solo", "solo")]


def test_dim_org_has_no_null_key(events):
    assert rows(dims.dim_org(events)) == [(7, "acme")]


def test_dim_time(events):
    got = [tuple(map(str, r)) for r in rows(dims.dim_time(events))]
    assert got == [
        ("None",) * 6,
        ("20240601", "2024-06-01", "2024", "6", "1", "7"),  # a Saturday
        ("20240602", "2024-06-02", "2024", "6", "2", "1"),
    ]


def test_action_marts_keep_a_missing_action_as_a_group(events):
    assert rows(marts.issue_activity(events)) == [(20240602, None, 1), (20240602, "closed", 1)]
    assert rows(marts.pr_throughput(events)) == [(20240602, "opened", 1)]


def test_session_zone_does_not_move_days(spark, raw):
    def days():
        return rows(facts.fact_events(raw).groupBy("date_key").count())

    before = days()
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert days() == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_profiles(raw, events):
    assert rows(profiles.grain(raw, events)) == [(len(LINES) - 3, len(LINES) - 3, True)]
    assert rows(profiles.fan_out(raw, facts.fact_commits(raw))) == [(3, 2, 2, True)]
    assert rows(profiles.payload_completeness(raw)) == [(3, 1, 1 / 3)]
    assert profiles.preview(events, 5).count() == 5
    shares = {r.repo_id: (r.row_count, r.share) for r in profiles.key_skew(events, "repo_id").collect()}
    total = len(LINES) - 3
    assert shares == {None: (1, 1 / total), 11: (1, 1 / total), 10: (total - 2, (total - 2) / total)}


def test_profiles_show_what_is_wrong(raw, events):
    assert rows(profiles.grain(raw, events.limit(3)), "holds") == [(False,)]
    assert rows(profiles.fan_out(raw, facts.fact_commits(raw).limit(1)), "holds") == [(False,)]
    sizes = profiles.dimension_sizes(events, {"dim_actor": dims.dim_actor(events), "copy": events})
    assert rows(sizes, "table_name", "row_count", "smaller") == [("copy", 24, False), ("dim_actor", 4, True)]
    mart = marts.events_by_type_per_day(events.filter("event_type != 'IssuesEvent'"))
    off = profiles.reconcile(events, mart).filter("difference != 0")
    assert rows(off) == [("IssuesEvent", 2, 0, 2)]


def test_no_pushes_at_all(raw):
    none = raw.filter("type = 'ForkEvent'")
    assert rows(profiles.payload_completeness(none)) == [(0, 0, None)]
    assert rows(profiles.fan_out(none, facts.fact_commits(none))) == [(0, 0, 0, True)]
