"""Marts and checks against a plain-Python count of the same rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from activitymill.contract import TABLES
from activitymill.operators import checks, dims, marts
from activitymill.operators.checks import GATE, Check
from tests.conftest import rows

TYPES = ["PushEvent", "PullRequestEvent", "IssuesEvent", "WatchEvent"]


@pytest.fixture(scope="module")
def data():
    """Three thousand events; one actor and one repository hold a third of them, and every key is null at times."""
    r = random.Random(7)
    made = []
    for i in range(3000):
        actor = 1 if r.random() < 0.33 else r.choice([None, *range(2, 40)])
        repo = 1 if r.random() < 0.33 else r.choice([None, *range(2, 60)])
        made.append((
            f"e{i}", r.choice(TYPES), actor, f"login-{actor}-{r.randint(0, 2)}", repo, f"own{repo}/r{r.randint(0, 1)}",
            r.choice([None, 5, 6]), None, r.choice([None, "opened", "closed"]),
            r.randint(1_717_200_000, 1_717_500_000), r.choice([20240601, 20240602, None]),
        ))
    return made


@pytest.fixture(scope="module")
def events(spark, data):
    df = spark.createDataFrame(data, TABLES["fact_events"].replace("created_ts TIMESTAMP", "created_ts BIGINT"))
    return df.withColumn("created_ts", F.timestamp_seconds("created_ts")).cache()


def test_counts_by_type(events, data):
    want = Counter((d[10], d[1]) for d in data)
    assert {(r.date_key, r.event_type): r.event_count for r in marts.events_by_type_per_day(events).collect()} == want


@pytest.mark.parametrize("mart, kind, name", [
    (marts.pr_throughput, "PullRequestEvent", "pr_count"), (marts.issue_activity, "IssuesEvent", "issue_count"),
])
def test_counts_by_action(events, data, mart, kind, name):
    want = Counter((d[10], d[8]) for d in data if d[1] == kind)
    assert {(r.date_key, r.action): r[name] for r in mart(events).collect()} == want


def test_dims_take_the_latest(events, data):
    want = {}
    for d in data:
        want[d[2]] = max(want.get(d[2], (0, "")), (d[9], d[3]))
    assert {r.actor_id: r.actor_login for r in dims.dim_actor(events).collect()} == {k: v[1] for k, v in want.items()}


def test_repo_mart_keeps_events_without_a_repository(events, data):
    dim = dims.dim_repo(events).filter("repo_id != 1")
    names = {r.repo_id: (r.repo_name, r.repo_owner) for r in dim.collect() if r.repo_id is not None}
    want = Counter((d[10], d[4], *names.get(d[4], (None, None)), d[1]) for d in data)
    got = marts.events_per_repo_per_day(events, dim)
    assert {tuple(r)[:5]: r.event_count for r in got.collect()} == want
    assert got.count() == len(want)


def test_counting_first_equals_joining_first(events):
    dim = dims.dim_repo(events)
    joined = (
        events.drop("repo_name").join(dim, "repo_id", "left")
        .groupBy("date_key", "repo_id", "repo_name", "repo_owner", "event_type").agg(F.count("*").alias("n"))
    )
    assert rows(marts.events_per_repo_per_day(events, dim)) == rows(joined)


def test_top_contributors_lists_all_actors(events, data):
    dim = dims.dim_actor(events).filter("actor_id != 1")
    logins = {r.actor_id: r.actor_login for r in dim.collect() if r.actor_id is not None}
    want = Counter((d[2], logins.get(d[2])) for d in data)
    assert {(r.actor_id, r.actor_login): r.event_count for r in marts.top_contributors(events, dim).collect()} == want


def test_marts_from_sightings_equal_marts_from_events(events):
    seen = dims.sightings(events, "repo_id", ["repo_name", "event_type"], ["date_key"])
    dim = dims.dim_repo(events)
    assert rows(dims.dim_repo(seen)) == rows(dim)
    assert rows(marts.events_per_repo_per_day(seen, dim)) == rows(marts.events_per_repo_per_day(events, dim))
    halves = [events.filter("event_id < 'e2'"), events.filter("event_id >= 'e2'")]
    parts = [dims.sightings(h, "actor_id", ["actor_login"]) for h in halves]
    assert rows(dims.dim_actor(parts[0].unionByName(parts[1]))) == rows(dims.dim_actor(events))


def tables(events):
    return {
        "fact_events": events,
        "dim_actor": dims.dim_actor(events), "dim_repo": dims.dim_repo(events),
        "dim_org": dims.dim_org(events), "dim_time": dims.dim_time(events),
    }


def failures(tables_, names=GATE):
    return {r.check_name: r.failures for r in checks.report(tables_, names).collect() if r.failures}


def test_gate_has_eleven_checks_with_verdicts(events):
    found = checks.report(tables(events)).collect()
    assert len(found) == len({r.check_name for r in found}) == 11
    for r in found:
        assert r.should_warn == r.should_error == (r.failures != 0)


def test_clean_tables_pass(events):
    clean = events.dropna(subset=["actor_id", "repo_id", "date_key"])
    assert failures(tables(clean)) == {}


def test_null_keys_fail_exactly_the_null_checks(events, data):
    assert failures(tables(events)) == {
        "not_null_dim_actor_actor_id": 1,
        "not_null_dim_repo_repo_id": 1,
        "not_null_dim_time_date_key": 1,
        "not_null_fact_events_actor_id": sum(d[2] is None for d in data),
    }


def test_planted_defects_are_counted(events, data):
    clean = events.dropna(subset=["actor_id", "repo_id", "date_key"])
    kept = [d for d in data if None not in (d[2], d[4], d[10])]
    t = tables(clean)
    actors, repos = t["dim_actor"].cache(), t["dim_repo"].cache()
    again = actors.filter("actor_id in (3, 4)")
    t["dim_actor"] = actors.filter("actor_id != 1").unionByName(again).unionByName(again)
    t["dim_repo"] = repos.filter("repo_id not in (2, 5)")
    assert failures(t) == {
        "unique_dim_actor_actor_id": 2,
        "relationship_fact_events_actor_id_in_dim_actor": sum(d[2] == 1 for d in kept),
        "relationship_fact_events_repo_id_in_dim_repo": sum(d[4] in (2, 5) for d in kept),
    }


@pytest.mark.parametrize("check", GATE, ids=lambda c: c.name)
def test_report_agrees_with_the_failing_rows(events, check):
    t = tables(events)
    doubled = t[check.table] if check.table == "fact_events" else t[check.table].unionByName(t[check.table])
    t = t | {check.table: doubled}
    if check.parent:
        t[check.parent] = t[check.parent].filter(F.col(check.parent_column) > 3)
    shown = checks.failing_rows(check, t).count()
    assert shown > 0 or check.name == "not_null_dim_org_org_id"
    assert failures(t, [check]) == ({check.name: shown} if shown else {})


def test_failing_rows_of_each_kind(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k BIGINT")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k BIGINT")
    assert rows(checks.orphans(child, "k", parent, "k")) == [(9,), (9,)]
    assert rows(checks.duplicate_keys(parent, "k")) == [(1, 2)]
    assert checks.null_rows(parent, "k").count() == 2
    own = [Check("unique", "child", "k"), Check("relationship", "child", "k", "parent", "k")]
    assert failures({"child": child, "parent": parent}, own) == {
        "unique_child_k": 1, "relationship_child_k_in_parent": 2,
    }


def test_empty_tables_pass(events):
    assert failures(tables(events.limit(0))) == {}
