"""The gated daily job, for one day or a span of days at once.

1. List the landed hours. A missing hour, a stub, an hour under two paths, and fewer hours than are stored for a day
   stop the run, unless the caller allows them.
2. Parse the hours once, and keep the events of the four types, flat, and the lines that do not fit.
3. Write facts, bad lines and sightings of these days (see ``operators.dims``), merge the sightings with what was known
   before, and build dimensions.
4. Run the checks on these tables, compare counts with what was parsed, and look at the share of bad lines. If one
   fails, stop and remove what was written.
5. Publish by moving one pointer (``sources.state``).

Each table is written once, below ``<table>/run=<run>``, where nothing refers to it until the pointer moves. So a run
that breaks off anywhere leaves readers with the state from before, and a later run of any days starts from that.
Folders that neither the new state nor the one before it refers to are removed after publishing.

What is stored per day is partitioned by the day it landed (``landed_day``): hourly files may hold events from the far
side of midnight, so replacing by event day would wipe the neighbouring day. Facts are partitioned by ``date_key``
below that. Running a day again replaces exactly what it had put in.

Dimensions and marts come from sightings, so publishing a day never reads old facts. Beside the sightings per day
there are merged ones over all days (``known_*``), so a new day is added to them without reading older days. A day
that runs again is taken out by merging the other days afresh.

Marts are worked out from stored counts when they are read, with current names, so no run rewrites the counts of older
days. ``marts_as="table"`` stores them as well.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce
from typing import TypeVar

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from activitymill.contract import (
    BAD_LINE, ISSUES, MARTS, MIN_HOUR_BYTES, PULL_REQUEST, PUSH, TABLES, TARGET_TYPES, columns,
)
from activitymill.functions.time import day_key, parse_day
from activitymill.operators import checks, dims, facts, marts, profiles, repeats
from activitymill.plans.shared import shared_folder
from activitymill.sources.landing import landing_manifest, scan_events
from activitymill.sources.ledger import Ledger
from activitymill.sources.state import State, listed, read_state, removed, write_state
from activitymill.sources.tables import balanced, create_view, write_table
from activitymill.sources.views import create_views, folder, nothing

T = TypeVar("T")
STAGED = (
    f"{TABLES['fact_events']}, commits ARRAY<STRUCT<sha: STRING, message: STRING>>, "
    f"{BAD_LINE} STRING, landed_day INT"
)
# Sightings per landed day: key, attributes, and what else is counted apart.
SIGHTED = {
    "actors": ("actor_id", ["actor_login"], []),
    "repos": ("repo_id", ["repo_name"], ["event_type"]),
    "orgs": ("org_id", ["org_login"], []),
}
BAD_LINES = f"{BAD_LINE} STRING, landed_day INT"
_EVENT = dict(part.split(maxsplit=1) for part in TABLES["fact_events"].split(", "))
# What is stored per landed day, and merged over all days, with its schema.
BY_DAY = {
    **{name: f"{TABLES[name]}, landed_day INT" for name in ("fact_events", "fact_commits")},
    "bad_lines": BAD_LINES,
    **{
        f"seen_{name}": ", ".join([
            "date_key INT, landed_day INT", *(f"{c} {_EVENT[c]}" for c in (key, *attributes, *apart)),
            "last_seen TIMESTAMP, event_count BIGINT",
        ]) for name, (key, attributes, apart) in SIGHTED.items()
    },
    "seen_types": "event_type STRING, action STRING, date_key INT, landed_day INT, event_count BIGINT",
}
# Stored per landed day by the runs that ask for it.
FILTERS = {"event_filters": f"landed_day INT, {repeats.FILTER}"}
MERGED = {
    **{name: TABLES[name] for name in ("dim_actor", "dim_repo", "dim_org", "dim_time")},
    **{
        f"known_{name}": ", ".join([
            *(f"{c} {_EVENT[c]}" for c in (key, *attributes)), "last_seen TIMESTAMP, event_count BIGINT",
        ]) for name, (key, attributes, _) in SIGHTED.items()
    },
}


class LandingError(Exception):
    """Hours are missing."""


class GateError(Exception):
    """A check failed; nothing was published."""

    def __init__(self, failed: list[Row]):
        super().__init__("; ".join(f"{r.check_name}: {r.failures}" for r in failed))
        self.failed = failed


@dataclass
class RunReport:
    first_day: str
    last_day: str
    hours: dict[str, int] = field(default_factory=dict)  # status to number of hours
    parsed_hours: list[tuple[str, int]] = field(default_factory=list)  # day and hour
    bad_lines: int = 0
    checks: list[Row] = field(default_factory=list)
    counts: dict[str, tuple[int, int]] = field(default_factory=dict)  # what was parsed, and what was written


@dataclass(frozen=True)
class Warehouse:
    """Published tables below one folder."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def run_path(self, table: str, run: str) -> str:
        return f"{self.path(table)}/run={run}"

    def state(self) -> State:
        return read_state(self.spark, self.root.rstrip("/"))

    def by_day(self, table: str, days: Mapping[str, str]) -> DataFrame:
        """A table that is stored per landed day, as of the runs that hold the days."""
        schema = (BY_DAY | FILTERS)[table]
        if not days:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(f"{schema}, run STRING").option("basePath", self.path(table))
        runs: dict[str, list[int]] = {}
        for day, run in days.items():
            runs.setdefault(run, []).append(int(day))
        held = reduce(lambda a, b: a | b, [
            (F.col("run") == run) & F.col("landed_day").isin(*own) for run, own in runs.items()
        ])
        return read.parquet(*[self.run_path(table, run) for run in runs]).filter(held).drop("run")

    def days_with(self, table: str, days: Mapping[str, str]) -> dict[str, str]:
        """Those of the days for which their run has stored the table."""
        parts = {run: listed(self.spark, self.run_path(table, run)) for run in set(days.values())}
        return {day: run for day, run in days.items() if f"landed_day={day}" in parts[run]}

    def merged(self, table: str, run: str | None) -> DataFrame:
        """A table over all days, as of a run."""
        if run is None:
            return self.spark.createDataFrame([], MERGED[table])
        return self.spark.read.schema(MERGED[table]).parquet(self.run_path(table, run))

    def table(self, name: str) -> DataFrame:
        """A published table in its public columns."""
        state = self.state()
        if name in BY_DAY:
            found = self.by_day(name, state.days)
        elif name in MERGED:
            found = self.merged(name, state.merged)
        elif state.marts:
            return self.spark.read.schema(TABLES[name]).parquet(self.run_path(name, state.marts))
        else:
            found = build_marts(self, state)[name]
        return found.select(*columns(name)) if name in TABLES else found


def at_once(jobs: Iterable[Callable[[], T]]) -> list[T]:
    """Submit independent Spark jobs side by side, so that small tables do not queue behind each other."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        return list(pool.map(lambda job: job(), jobs))


def day_sightings(events: DataFrame) -> dict[str, DataFrame]:
    """What dimensions and marts need to know of each day, from fact_events with ``landed_day``."""
    by = ["date_key", "landed_day"]
    named = {
        f"seen_{name}": dims.sightings(events.filter(F.col(key).isNotNull()) if name == "orgs" else events,
                                       key, [*attributes, *apart], by)
        for name, (key, attributes, apart) in SIGHTED.items()
    }
    return named | {"seen_types": marts.grouped_count(events, ["event_type", "action", *by])}


def known(name: str, seen: DataFrame, before: DataFrame | None) -> DataFrame:
    """Sightings merged over all days: those of the new days, and merged or single ones of all others."""
    key, attributes, _ = SIGHTED[name]
    parts = [seen] if before is None else [seen, before]
    wanted = [key, *attributes, "last_seen", "event_count"]
    return dims.sightings(reduce(DataFrame.unionByName, [p.select(*wanted) for p in parts]), key, attributes)


def build_dims(merged: dict[str, DataFrame], types: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_actor": dims.dim_actor(merged["actors"]),
        "dim_repo": dims.dim_repo(merged["repos"]),
        "dim_org": dims.dim_org(merged["orgs"]),
        "dim_time": dims.dim_time(types),
    }


def build_marts(house: Warehouse, state: State) -> dict[str, DataFrame]:
    """The five marts from stored counts and dimensions."""
    types, repos = (house.by_day(name, state.days) for name in ("seen_types", "seen_repos"))
    actors, dim_actor, dim_repo = (
        house.merged(name, state.merged) for name in ("known_actors", "dim_actor", "dim_repo")
    )
    return {
        "events_by_type_per_day": marts.events_by_type_per_day(types),
        "events_per_repo_per_day": marts.events_per_repo_per_day(repos, dim_repo),
        "pr_throughput": marts.pr_throughput(types),
        "issue_activity": marts.issue_activity(types),
        "top_contributors": marts.top_contributors(actors, dim_actor),
    }


# The marts as SQL text, for views that outlast a session; names in braces are views themselves.
MART_TEXTS = {
    "events_by_type_per_day":
        "SELECT date_key, event_type, SUM(event_count) AS event_count FROM {seen_types} GROUP BY date_key, event_type",
    "events_per_repo_per_day":
        "SELECT date_key, c.repo_id, repo_name, repo_owner, event_type, c.event_count FROM ("
        "SELECT date_key, repo_id, event_type, SUM(event_count) AS event_count FROM {seen_repos} "
        "GROUP BY date_key, repo_id, event_type) AS c LEFT JOIN {dim_repo} AS d ON c.repo_id = d.repo_id",
    "pr_throughput":
        f"SELECT date_key, action, SUM(event_count) AS pr_count FROM {{seen_types}} WHERE event_type = '{PULL_REQUEST}' "
        "GROUP BY date_key, action",
    "issue_activity":
        f"SELECT date_key, action, SUM(event_count) AS issue_count FROM {{seen_types}} WHERE event_type = '{ISSUES}' "
        "GROUP BY date_key, action",
    "top_contributors":
        "SELECT c.actor_id, actor_login, event_count FROM (SELECT actor_id, SUM(event_count) AS event_count "
        "FROM {known_actors} GROUP BY actor_id) AS c LEFT JOIN {dim_actor} AS d ON c.actor_id = d.actor_id",
}


def view_texts(house: Warehouse, state: State) -> dict[str, str]:
    """SQL text per published table and mart, as of a state. All files of a state stay until two runs later."""
    texts = dict(MART_TEXTS)
    for name, schema in BY_DAY.items():
        runs: dict[str, list[str]] = {}
        for day, run in sorted(state.days.items()):
            runs.setdefault(run, []).append(day)
        held = " OR ".join(f"(run = '{run}' AND landed_day IN ({', '.join(days)}))" for run, days in runs.items())
        texts[name] = folder(house.spark, house.path(name), schema, held) if held else nothing(schema)
    for name, schema in MERGED.items():
        texts[name] = folder(house.spark, house.run_path(name, state.merged), schema) if state.merged else nothing(schema)
    return texts


def lasting_views(house: Warehouse, database: str, state: State | None = None) -> list[str]:
    """Register what is published as lasting views of a database; names, in the order of creation.

    ``run_days(database=...)`` does so after each publishing. Another application without a stored metastore calls
    this once with the warehouse's folder.
    """
    return create_views(house.spark, database, view_texts(house, state or house.state()))


def export(
    house: Warehouse, fmt: str, options: Callable[[str], Mapping[str, str]], tables: Iterable[str] = tuple(TABLES)
) -> None:
    """Replace tables of another store by the published ones, through its connector.

    ``options`` gives the connector's options for a table name.
    """
    def put(name: str) -> None:
        # Formats registered in a session are found by threads whose session it is; making a DataFrame makes it so.
        house.spark.createDataFrame([], "none INT")
        write_table(house.table(name), None, fmt=fmt, options=options(name))

    at_once(partial(put, name) for name in tables)


def stage(spark: SparkSession, paths: list[str], to: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Parse landed hours once; keep the wanted types, flat, and any line that does not fit the contract.

    Every reader takes all rows, so days get folders of their own only where ``by`` asks for them: a task has hours of
    many days, and would sort its rows and write a file for each.
    """
    scanned = scan_events(spark, paths, with_source=True)
    kept = F.col("type").isin(*TARGET_TYPES) | F.col(BAD_LINE).isNotNull()
    more = dict.fromkeys(("landed_day", *by))
    flat = facts.flatten(scanned.filter(kept), F.col("payload.commits").alias("commits"), BAD_LINE, *more)
    write_table(flat, to, by)
    return spark.read.schema(STAGED).parquet(to)


def hour_ledger(spark: SparkSession, root: str) -> Ledger:
    """The ledger of hours below a folder, whose rows are those that ``stage`` makes."""
    return Ledger(spark, root, STAGED, lambda paths, to: stage(spark, paths, to, ("landed_day", "landed_hour")))


def landed(
    house: Warehouse, landing_dir: str, first_day: str, last_day: str, min_hour_bytes: int, allow_missing_hours: bool,
    allow_fewer_hours: bool, report: RunReport,
) -> tuple[list[Row], dict[str, int]]:
    """The hours to load and how many each day has; raises if hours are missing that may not be."""
    hours = landing_manifest(  # 24 rows a day
        house.spark, landing_dir, first_day, last_day, min_hour_bytes
    ).collect()
    report.hours = {s: sum(h.status == s for h in hours) for s in ("ok", "stub", "missing", "ambiguous")}
    good = [h for h in hours if h.status == "ok"]
    loaded = {str(day_key(h.day)): 0 for h in hours}
    for h in good:
        loaded[str(day_key(h.day))] += 1
    problems = []
    if report.hours["ambiguous"]:
        problems.append("hours under several paths: " + ", ".join(
            sorted(f"{h.day}-{h.hour}" for h in hours if h.status == "ambiguous")))
    # A day with no hour at all would replace what is stored by nothing.
    empty = sorted({str(h.day) for h in hours} - {str(h.day) for h in good})
    if empty:
        problems.append(f"days without any hour: {empty}")
    if len(good) < len(hours) and not allow_missing_hours:
        problems.append("hours are missing or stubs")
    stored = house.state().hours
    fewer = sorted(d for d, n in loaded.items() if n < stored.get(d, 0))
    if fewer and not allow_fewer_hours:
        problems.append(f"fewer hours than are stored: {fewer}")
    if problems:
        raise LandingError(f"{first_day} to {last_day}: {report.hours}, {'; '.join(problems)}")
    return good, loaded


def reconciled(staged: DataFrame, house: Warehouse, days: Mapping[str, str]) -> dict[str, tuple[int, int]]:
    """What was parsed against what was written: kept events and fact rows, listed and stored commits, per event type
    the fact rows and the counts behind the marts, and groups (of type and day) of events against those whose content
    is stored as it was parsed."""
    push = F.col("event_type") == PUSH
    parsed = staged.agg(
        F.count_if(F.col("event_type").isin(*TARGET_TYPES)).alias("events"),
        F.coalesce(F.sum(F.when(push, F.array_size("commits"))), F.lit(0)).alias("commits"),
    ).first()
    events, commits, counts = (house.by_day(name, days) for name in ("fact_events", "fact_commits", "seen_repos"))
    by_type = profiles.reconcile(events, counts).collect()  # a row per kept type
    kept = staged.filter(F.col("event_type").isin(*TARGET_TYPES))
    content = profiles.reconcile_content(
        kept, events, ["event_type", "date_key", "landed_day"], columns("fact_events")
    ).agg(F.count("*").alias("groups"), F.count_if(~F.col("differs")).alias("alike")).first()
    return {
        "events": (parsed.events, sum(r.fact_count for r in by_type)),
        "commits": (parsed.commits, commits.count()),
        "content": (content.groups, content.alike),
        **{f"mart_{r.event_type}": (r.fact_count, r.mart_count) for r in by_type},
    }


def repeated_events(house: Warehouse, new: Mapping[str, str], others: Mapping[str, str]) -> DataFrame:
    """Events of the new days that are stored more than once, on these or the other days, with how often."""
    filtered = house.days_with("event_filters", others)
    events, old = house.by_day("fact_events", new), house.by_day("fact_events", filtered)
    known_ids = repeats.known_rows(events, old, house.by_day("event_filters", filtered), "event_id").select("event_id")
    unfiltered = house.by_day("fact_events", {d: r for d, r in others.items() if d not in filtered})
    found = events.select("event_id").unionByName(known_ids).unionByName(unfiltered.select("event_id"))
    repeated = checks.duplicate_keys(found, "event_id")
    if len(filtered) == len(others):
        return repeated
    # What is only repeated among the other days is no fault of these.
    return repeated.join(events.select(F.col("event_id").alias("unique_field")), "unique_field", "left_semi")


def run_days(
    spark: SparkSession,
    first_day: str,
    last_day: str | None = None,
    *,
    landing_dir: str,
    warehouse: str,
    allow_missing_hours: bool = False,
    allow_fewer_hours: bool = False,
    min_hour_bytes: int = MIN_HOUR_BYTES,
    max_bad_share: float = 0.25,
    marts_as: str = "view",
    database: str | None = None,
    unique_events: bool = False,
    ledger: str | None = None,
    verify_hours: bool = False,
) -> RunReport:
    """Load the landed hours of the days, check them, and publish. Raises if a check fails.

    Of the kept events and bad lines of a day, at most ``max_bad_share`` may be bad lines; these are published in the
    table ``bad_lines``. With ``marts_as="view"`` the marts are registered in the session and worked out when read;
    with ``"table"`` they are stored too. With a ``database``, all published tables and marts become views of it that
    outlast the session. ``unique_events`` adds the check that no event of these days is stored twice, on these days
    or on others, by whose filters it looks (``operators.repeats``); events of stored days without one are read.

    With ``ledger``, a folder, parsed hours are kept there (``sources.ledger``), and only hours that are new or changed
    since are parsed; ``verify_hours`` compares all hours by content, also those of the size and time they had.
    """
    first, last = parse_day(first_day), parse_day(last_day or first_day)
    house, work = Warehouse(spark, warehouse), shared_folder(spark)
    report = RunReport(first.isoformat(), last.isoformat())
    good, hours = landed(
        house, landing_dir, report.first_day, report.last_day, min_hour_bytes, allow_missing_hours, allow_fewer_hours,
        report,
    )
    before, run = house.state(), uuid.uuid4().hex
    try:
        if ledger:
            kept = hour_ledger(spark, ledger)
            taken = kept.update(good, verify=verify_hours)
            report.parsed_hours = [(str(day_key(h.day)), h.hour) for h in taken if h.status != "same"]
            staged = kept.rows(taken).drop("landed_hour")
        else:
            report.parsed_hours = [(str(day_key(h.day)), h.hour) for h in good]
            staged = stage(spark, [h.path for h in good], f"{work}/staged")
        after = _written(house, staged, before, run, hours, report, max_bad_share, marts_as, unique_events)
        write_state(spark, house.root.rstrip("/"), after)
    except BaseException:
        for name in (*BY_DAY, *FILTERS, *MERGED, *MARTS):
            removed(spark, house.run_path(name, run))
        raise
    finally:
        removed(spark, work)
    if database:
        lasting_views(house, database, after)
    _swept(house, before, after)
    if marts_as == "view":
        for name, df in build_marts(house, after).items():
            create_view(df, name)
    return report


def _written(
    house: Warehouse, staged: DataFrame, before: State, run: str, hours: Mapping[str, int], report: RunReport,
    max_bad_share: float, marts_as: str, unique_events: bool,
) -> State:
    """Write everything that the run adds, check it, and return the state that would publish it."""
    bad = staged.filter(F.col(BAD_LINE).isNotNull())
    events = staged.filter(F.col("event_type").isin(*TARGET_TYPES)).select(*columns("fact_events"), "landed_day")
    commits = facts.explode_commits(staged.filter(F.col("event_type") == PUSH), "landed_day")

    def put(name: str, df: DataFrame, by: tuple[str, ...] = ()) -> None:
        # Without balancing, each task would write a file per day.
        write_table(balanced(df, "landed_day") if by else df, house.run_path(name, run), by)

    new = {day: run for day in hours}
    after = State(before.number + 1, before.days | new, before.hours | dict(hours), run, None)
    day = ("landed_day",)
    at_once([
        partial(put, "fact_events", events, (*day, "date_key")),
        partial(put, "fact_commits", commits, (*day, "date_key")),
        partial(put, "bad_lines", bad.select(BAD_LINE, "landed_day"), day),
        *[partial(put, name, df, day) for name, df in day_sightings(events).items()],
    ])
    others = {d: r for d, r in before.days.items() if d not in new}
    again = len(others) < len(before.days)  # a day is replaced, so it has to be taken out of what was merged

    def rest(name: str) -> DataFrame | None:
        if not others:
            return None
        return house.by_day(f"seen_{name}", others) if again else house.merged(f"known_{name}", before.merged)

    at_once(
        partial(put, f"known_{name}", known(name, house.by_day(f"seen_{name}", new), rest(name))) for name in SIGHTED
    )
    merged = {name: house.merged(f"known_{name}", run) for name in SIGHTED}
    times = house.by_day("seen_types", new).select("date_key")
    if others:  # the days' keys of the old dimension can stay unless a day is replaced
        old = house.by_day("seen_types", others) if again else house.merged("dim_time", before.merged)
        times = times.unionByName(old.select("date_key"))
    at_once(partial(put, name, df) for name, df in build_dims(merged, times).items())

    found = {name: house.merged(name, run) for name in ("dim_actor", "dim_repo", "dim_org", "dim_time")}
    report.checks = checks.report({"fact_events": house.by_day("fact_events", new), **found}).collect()
    report.counts = reconciled(staged, house, new)
    per_day = staged.groupBy("landed_day").agg(
        F.count_if(F.col(BAD_LINE).isNotNull()).alias("bad"), F.count("*").alias("lines")
    ).collect()  # a row per day
    report.bad_lines = sum(r.bad for r in per_day)
    extra = {
        "bad_lines": sum(r.bad for r in per_day if r.bad > max_bad_share * r.lines),
        **{f"reconcile_{name}": abs(a - b) for name, (a, b) in report.counts.items()},
    }
    if unique_events:
        put("event_filters", repeats.key_filters(house.by_day("fact_events", new), "event_id", day), day)
        extra["unique_fact_events_event_id"] = repeated_events(house, new, others).count()
    failed = [r for r in report.checks if r.should_error]
    failed += [Row(check_name=name, failures=n) for name, n in extra.items() if n]
    if failed:
        raise GateError(failed)
    if marts_as == "table":
        at_once(partial(put, name, df) for name, df in build_marts(house, after).items())
        after.marts = run
    return after


def _swept(house: Warehouse, before: State, after: State) -> None:
    """Remove what neither the new state nor the one before it refers to."""
    spark, runs = house.spark, before.runs() | after.runs()
    held = {(run, day) for state in (before, after) for day, run in state.days.items()}
    merged = {before.merged, after.merged}
    stored = {before.marts, after.marts}
    for name in (*BY_DAY, *FILTERS, *MERGED, *MARTS):
        for folder in listed(spark, house.path(name)):
            run = folder.removeprefix("run=")
            wanted = run in (runs if name in BY_DAY | FILTERS else merged if name in MERGED else stored)
            if not wanted:
                removed(spark, f"{house.path(name)}/{folder}")
            elif name in BY_DAY | FILTERS:
                for part in listed(spark, f"{house.path(name)}/{folder}"):
                    if part.startswith("landed_day=") and (run, part.removeprefix("landed_day=")) not in held:
                        removed(spark, f"{house.path(name)}/{folder}/{part}")
