"""The plans that let the operators scale: what reaches the scan, what is counted before a join, what is shuffled."""

import re

import pytest

from activitymill.contract import RAW_SCHEMA, TABLES
from activitymill.operators import checks, dims, facts, marts
from activitymill.sources.landing import scan_events
from tests.test_contract import LINES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The hand-made records as JSON lines and as Parquet, and the tables built from them, all read from disk."""
    root = tmp_path_factory.mktemp("plans")
    (root / "raw.json").write_text("\n".join(LINES))
    raw = scan_events(spark, str(root / "raw.json"))
    raw.write.parquet(str(root / "raw"))
    parquet = spark.read.schema(RAW_SCHEMA).parquet(str(root / "raw"))
    built = {"fact_events": facts.fact_events(raw)}
    built |= {f"dim_{n}": getattr(dims, f"dim_{n}")(built["fact_events"]) for n in ("actor", "repo", "org", "time")}
    for name, df in built.items():
        df.write.parquet(str(root / name))
    tables = {name: spark.read.schema(TABLES[name]).parquet(str(root / name)) for name in built}
    return {"json": raw, "parquet": parquet, **tables}


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_type_filter_and_columns_reach_the_json_scan(stored):
    text = plan(facts.fact_events(stored["json"]).select("event_id", "actor_id"))
    assert "PushedFilters: [In(type, [IssuesEvent,PullRequestEvent,PushEvent,WatchEvent])]" in text
    assert "created_at" not in text.split("ReadSchema:")[1] and "payload" not in text.split("ReadSchema:")[1]


def test_parquet_scan_reads_only_the_nested_fields_used(stored):
    text = plan(facts.fact_commits(stored["parquet"]).select("commit_sha"))
    assert "EqualTo(type,PushEvent)" in text
    assert "payload:struct<commits:array<struct<sha:string>>>" in text


def test_dims_hash_events_down_before_the_first_shuffle(stored):
    for build in (dims.dim_actor, dims.dim_repo, dims.dim_org, dims.dim_time):
        text = plan(build(stored["fact_events"]))
        # The scan is hashed down before anything is shuffled or sorted.
        last = text.rindex("Exchange hashpartitioning")
        assert "HashAggregate(keys=[" in text[last:] and "Sort" not in text[last:]
        assert text.count("Exchange hashpartitioning") == (1 if build is dims.dim_time else 2)


def test_dim_time_reads_one_column(stored):
    assert "ReadSchema: struct<date_key:int>" in plan(dims.dim_time(stored["fact_events"]))


@pytest.mark.parametrize("build", [
    lambda t: marts.events_per_repo_per_day(t["fact_events"], t["dim_repo"]),
    lambda t: marts.top_contributors(t["fact_events"], t["dim_actor"]),
])
def test_marts_count_before_they_join(stored, no_broadcast, build):
    above, below = plan(build(stored)).split("SortMergeJoin", 1)
    assert "Aggregate" not in above
    assert "partial_count" in below and below.index("HashAggregate") < below.index("partial_count")


def test_date_marts_have_no_join(stored):
    for build in (marts.events_by_type_per_day, marts.pr_throughput, marts.issue_activity):
        text = plan(build(stored["fact_events"]))
        assert "Join" not in text and text.count("Exchange hashpartitioning") == 1
        assert "actor" not in text.split("ReadSchema:")[1]
    assert "EqualTo(event_type,IssuesEvent)" in plan(marts.issue_activity(stored["fact_events"]))


def test_orphans_are_an_anti_join(stored, no_broadcast):
    text = plan(checks.orphans(stored["fact_events"], "actor_id", stored["dim_actor"], "actor_id"))
    assert "SortMergeJoin" in text and "LeftAnti" in text and "LeftOuter" not in text


def test_report_joins_counted_keys_only(stored, no_broadcast):
    text = plan(checks.report(stored))
    assert text.count("SortMergeJoin") == 2
    for joined in text.split("SortMergeJoin")[1:]:
        left = joined.split("FileScan")[0]
        assert "HashAggregate(keys=[" in left and "partial_count" in left
    assert text.count("FileScan") == 8  # four dims and two fact columns, and two dims again as parents


def test_no_plan_pairs_rows_or_leaves_the_jvm(spark):
    entry = pytest.importorskip("__spark_entry__")
    data = "/root/testdata/sf0.001"
    eager = ("daily_", "ndjson", "line_", "landing", "hours", "table_", "day_replaced")
    for name, query in entry.queries().items():
        if name.startswith(eager) or re.match(r"op\d+_|pipeline$", name):
            continue
        if name == "exported_parts":  # reads through a connector that is written in Python
            continue
        text = plan(query(spark, data))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition, REPARTITION"):
            assert word not in text, (name, word)
