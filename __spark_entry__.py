"""

All queries run over raw records made from the whole ``events`` table (see ``activitymill.sources.sample``). Most
build on them directly; the ones on files land them as gzip JSON lines first, and the daily ones run the whole
job on that landing and read what it published.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activitymill.contract import MARTS, PUSH, TABLES
from activitymill.functions.time import day_key, utc_wall_clock
from activitymill.operators import checks, dims, facts, marts, profiles, repeats, skew
from activitymill.plans import daily
from activitymill.plans.shared import shared_folder
from activitymill.sources import connector, landing, sample, tables

try:
    import corpus_pipeline
    from activitymill.llm import queries as llm
except ModuleNotFoundError as absent:  # these may be taken out; any other missing module is an error
    if absent.name not in ("corpus_pipeline", "activitymill.llm"):
        raise
    corpus_pipeline = llm = None

FIRST_DAY, LAST_DAY = "2024-01-01", "2024-01-30"  # the days the events table spans


def _plain(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock time and dates as text, which compare alike in every engine and time zone."""
    for name, kind in df.dtypes:
        if kind == "timestamp":
            df = df.withColumn(name, utc_wall_clock(F.col(name)))
        elif kind == "date":
            df = df.withColumn(name, F.col(name).cast("string"))
    return df


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_events(sample.raw_events(spark, sf_dir))


def _on_raw(build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _plain(build(sample.raw_events(spark, sf_dir)))


def _on_events(build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _plain(build(_events(spark, sf_dir)))


# --- checks, on tables as built and on tables with planted defects -------------------------------------------


def _clean_tables(events: DataFrame) -> dict[str, DataFrame]:
    return {
        "fact_events": events,
        "dim_actor": dims.dim_actor(events),
        "dim_repo": dims.dim_repo(events),
        "dim_org": dims.dim_org(events),
        "dim_time": dims.dim_time(events),
    }


def _broken_tables(events: DataFrame) -> dict[str, DataFrame]:
    """Actors ending in 7 are missing and those ending in 3 twice; repositories of such actors have no key;
    the actor of watch events is unknown where it ends in 1."""
    built = _clean_tables(events)
    actors, repos = built["dim_actor"], built["dim_repo"]
    ends_in = F.col("actor_id") % 10
    unknown = (F.col("event_type") == "WatchEvent") & (ends_in == 1)
    no_key = F.floor(F.col("repo_id") / 5) % 10 == 7
    return built | {
        "fact_events": events.withColumn("actor_id", F.when(~unknown, F.col("actor_id"))),
        "dim_actor": actors.filter(ends_in != 7).unionByName(actors.filter(ends_in == 3)),
        "dim_repo": repos.withColumn("repo_id", F.when(~no_key, F.col("repo_id"))),
    }


def _gappy_tables(events: DataFrame) -> dict[str, DataFrame]:
    """A third actor has over a quarter of the events; actors ending in 7 and repositories ending in 3 are missing;
    the actor and repository of some events are unknown."""
    digits = F.regexp_extract("event_id", r"(\d\d?)$", 1).cast("int")
    built = _clean_tables(events)
    return {
        "fact_events": events.withColumns({
            "actor_id": F.when(digits < 27, 3).when(digits < 95, F.col("actor_id")),
            "repo_id": F.when(digits < 93, F.col("repo_id")),
        }),
        "dim_actor": built["dim_actor"].filter(F.col("actor_id") % 10 != 7),
        "dim_repo": built["dim_repo"].filter(F.col("repo_id") % 10 != 3),
    }


def _worse_tables(events: DataFrame) -> dict[str, DataFrame]:
    """Null and repeated keys in every dimension."""
    built = _clean_tables(events)

    def spoiled(name: str, key: str) -> DataFrame:
        df = built[name]
        null = df.filter(F.col(key) % 4 == 1).withColumn(key, F.lit(None).cast(df.schema[key].dataType))
        return df.unionByName(df.filter(F.col(key) % 4 == 0)).unionByName(null)

    return built | {
        name: spoiled(name, key) for name, key in (
            ("dim_actor", "actor_id"), ("dim_repo", "repo_id"), ("dim_org", "org_id"), ("dim_time", "date_key"))
    }


# --- files and published tables -----------------------------------------------------------------------------

_made: dict[tuple[str, str, str], str] = {}
_ledgers: dict[str, list] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, make: Callable[[str], object]) -> str:
    """Folder holding something made from the tables, made once per Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _made:
        folder = shared_folder(spark)
        make(folder)
        _made[key] = folder
    return _made[key]


def _landing(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "landing", lambda to: sample.land(sample.raw_events(spark, sf_dir), to))


def _warehouse(spark: SparkSession, sf_dir: str) -> daily.Warehouse:
    # Sample hours are far smaller than real ones, so any size counts as landed.
    root = _once(spark, sf_dir, "warehouse", lambda to: daily.run_days(
        spark, FIRST_DAY, LAST_DAY, landing_dir=_landing(spark, sf_dir), warehouse=to, min_hour_bytes=1,
        allow_missing_hours=True,
    ))
    return daily.Warehouse(spark, root)


def _published(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _plain(_warehouse(spark, sf_dir).table(name))


def _lasting(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A published table by its name in the catalog."""
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        house = _warehouse(spark, sf_dir)
        database = f"activity_{house.root.rsplit('-', 1)[-1]}"
        if not spark.catalog.databaseExists(database):
            daily.lasting_views(house, database)
        return _plain(tables.read_table(spark, f"{database}.{name}"))

    return read


def _ndjson_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The sample's hours are folders named hour_file=<hour>, hence the leading star.
    scanned = landing.scan_events(spark, f"{_landing(spark, sf_dir)}/*.json.gz")
    return scanned.select(
        "id", "type", "created_at",
        F.col("actor.id").alias("actor_id"), F.col("repo.name").alias("repo_name"),
        F.col("org.login").alias("org_login"), F.col("payload.action").alias("action"),
        F.array_size("payload.commits").alias("commit_count"),
    )


def _ndjson_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = landing.day_glob(_landing(spark, sf_dir), "20240115", prefix="*")
    return landing.scan_events(spark, paths).select("id", "type", "created_at")


def _exported_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(to: str) -> None:
        daily.export(_warehouse(spark, sf_dir), "orc", lambda name: {"path": f"{to}/{name}"}, ("fact_events",))

    folder = _once(spark, sf_dir, "exported", write)
    return _plain(tables.read_table(spark, f"{folder}/fact_events", "orc"))


def _daily_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _warehouse(spark, sf_dir).table("bad_lines").groupBy("landed_day").agg(F.count("*").alias("bad_lines"))


def _line_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.line_health(landing.scan_events(spark, f"{_landing(spark, sf_dir)}/*.json.gz", with_source=True))


def _landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = landing.landing_manifest(spark, _landing(spark, sf_dir), FIRST_DAY, LAST_DAY, min_bytes=1)
    return _plain(hours.select("day", "hour", "status"))


def _ledger_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours as a second run meets them: those from 20 o'clock on are late, those at 7 o'clock have come again."""
    raw, hour = sample.raw_events(spark, sf_dir), F.substring("created_at", 12, 2).cast("int")
    found: dict[str, list] = {}

    def hours_of(folder: str) -> list:
        manifest = landing.landing_manifest(spark, folder, FIRST_DAY, LAST_DAY, min_bytes=1)
        return manifest.filter("status = 'ok'").collect()  # 24 rows a day

    def keep(to: str) -> None:
        ledger = daily.hour_ledger(spark, f"{to}/ledger")
        sample.land(raw.filter(hour < 20).withColumn("id", F.when(hour == 7, F.concat(F.lit("x"), "id")).otherwise(F.col("id"))),
                    f"{to}/first")
        ledger.update(hours_of(f"{to}/first"))
        found[to] = ledger.update(hours_of(_landing(spark, sf_dir)))

    root = _once(spark, sf_dir, "ledger", keep)
    ledger = daily.hour_ledger(spark, f"{root}/ledger")
    _ledgers.update(found)
    after = _ledgers[root]
    counts = ledger.rows(after).groupBy("landed_day", "landed_hour").agg(F.count("*").alias("kept_rows"))
    status = spark.createDataFrame([(day_key(h.day), h.hour, h.status) for h in after],
                                   "landed_day INT, landed_hour INT, status STRING")
    return status.join(counts, ["landed_day", "landed_hour"], "left").fillna(0, ["kept_rows"])


def _hours_to_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(landing.hours_to_fetch(spark, _landing(spark, sf_dir), FIRST_DAY, "2024-01-31", min_bytes=0))


def _table_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(to: str) -> None:
        events = _events(spark, sf_dir)
        tables.write_table(events.limit(0), to)
        tables.write_table(events, to)

    return _plain(tables.read_table(spark, _once(spark, sf_dir, "replaced", write), "parquet"))


def _day_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(to: str) -> None:
        events = _events(spark, sf_dir)
        tables.write_partitions(events, to, ["date_key"])
        again = events.filter(F.col("date_key") == 20240115).withColumn("action", F.lit("again"))
        tables.write_partitions(again, to, ["date_key"])

    return _plain(tables.read_table(spark, _once(spark, sf_dir, "day", write), "parquet"))


def _table_from_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    def name(folder: str) -> str:
        return f"pr_throughput_{folder.rsplit('-', 1)[-1]}"

    def create(to: str) -> None:
        tables.create_table_as(marts.pr_throughput(_events(spark, sf_dir)), name(to), path=to)

    return tables.read_table(spark, name(_once(spark, sf_dir, "created", create)))


def _table_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the wrong rows, whose replacement by a query that fails and then by the right one readers don't see."""
    def name(folder: str) -> str:
        return f"issue_activity_{folder.rsplit('-', 1)[-1]}"

    def create(to: str) -> None:
        right = marts.issue_activity(_events(spark, sf_dir))
        tables.replace_table_as(right.filter("action = 'closed'"), name(to), to)
        broken = right.withColumn("issue_count", F.raise_error(F.lit("planted")).cast("long"))
        try:
            tables.replace_table_as(broken, name(to), to)
        except Exception as e:
            if "planted" not in str(e):
                raise
        tables.replace_table_as(spark.table(name(to)).limit(0).unionByName(right), name(to), to)

    return tables.read_table(spark, name(_once(spark, sf_dir, "moved", create)))


def _exported_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    connector.register(spark)

    def write(to: str) -> None:
        daily.export(_warehouse(spark, sf_dir), "parts", lambda name: {"path": f"{to}/{name}"}, ("fact_commits",))

    return _plain(tables.read_table(spark, f"{_once(spark, sf_dir, 'parts', write)}/fact_commits", "parts"))


def _mart_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.create_view(marts.issue_activity(_events(spark, sf_dir)), "issue_activity_view")
    return tables.read_table(spark, "issue_activity_view")


def _events_with_actor_names(events: DataFrame) -> DataFrame:
    built = _gappy_tables(events)
    return skew.fact_with_names(built["fact_events"], built["dim_actor"], "actor_id", {"actor_login": "actor_name"})


def _events_with_every_name(events: DataFrame) -> DataFrame:
    """Each event with all names that its actor has had, with heavy keys dealt over salts."""
    gappy = _gappy_tables(events)["fact_events"]
    names = events.select("actor_id", F.col("actor_login").alias("any_name")).distinct()
    return skew.split_join(gappy, names, "actor_id", "inner", most_heavy=0).select("event_id", "actor_id", "any_name")


def _content(spark: SparkSession, sf_dir: str, swapped: bool = False) -> DataFrame:
    """Published facts against those straight from the records, per type and day."""
    stored = _warehouse(spark, sf_dir).table("fact_events")
    if swapped:  # the same numbers of rows, actors of some mixed up
        stored = stored.withColumn("actor_id", F.when(F.col("event_id").endswith("77"), F.col("actor_id") + 1)
                                   .otherwise(F.col("actor_id")))
    return profiles.reconcile_content(_events(spark, sf_dir), stored, ["date_key", "event_type"], stored.columns)


def _heavy_keys(events: DataFrame) -> DataFrame:
    gappy = _gappy_tables(events)["fact_events"]
    found = [
        skew.heavy_keys(gappy, key, 0.005, skew.key_sketches(gappy, key, ["date_key"], 0.005))
        .select(F.lit(key).alias("key_name"), F.col(key).alias("key"), "row_count", "share")
        for key in ("actor_id", "repo_id", "org_id")
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


def _repeated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events ending in 77 landed a day later too, those ending in 177 twice; the second half of the month is new and
    finds them by the stored filters of the first."""
    day = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")
    landed = _events(spark, sf_dir).select("event_id", F.col("date_key").alias("landed_day"), day.alias("d"))
    late = landed.filter(F.col("event_id").endswith("77")).withColumn(
        "landed_day", F.date_format(F.date_add("d", 1), "yyyyMMdd").cast("int"))
    events = landed.unionByName(late).unionByName(late.filter(F.col("event_id").endswith("177"))).drop("d")
    old = events.filter("landed_day < 20240116")

    def write(to: str) -> None:
        tables.write_table(repeats.key_filters(old, "event_id", ["landed_day"]), to, ["landed_day"])

    filters = spark.read.parquet(_once(spark, sf_dir, "filters", write))
    return repeats.repeated_keys(events.filter("landed_day >= 20240116"), old, filters, "event_id")


# --- registry -------------------------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Events per day and type, from raw nested records."""
    return marts.events_by_type_per_day(_events(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "fact_events": _on_raw(facts.fact_events),
        "fact_commits": _on_raw(facts.fact_commits),
        "dim_actor": _on_events(dims.dim_actor),
        "dim_repo": _on_events(dims.dim_repo),
        "dim_org": _on_events(dims.dim_org),
        "dim_time": _on_events(dims.dim_time),
        "events_by_type_per_day": _on_events(marts.events_by_type_per_day),
        "events_per_repo_per_day": _on_events(lambda e: marts.events_per_repo_per_day(e, dims.dim_repo(e))),
        "pr_throughput": _on_events(marts.pr_throughput),
        "issue_activity": _on_events(marts.issue_activity),
        "top_contributors": _on_events(lambda e: marts.top_contributors(e, dims.dim_actor(e))),
        "dq_report": _on_events(lambda e: checks.report(_clean_tables(e))),
        "dq_report_broken": _on_events(lambda e: checks.report(_broken_tables(e))),
        "dq_duplicate_keys": _on_events(
            lambda e: checks.duplicate_keys(_broken_tables(e)["dim_actor"], "actor_id")
        ),
        "dq_null_rows": _on_events(lambda e: checks.null_rows(_broken_tables(e)["dim_repo"], "repo_id")),
        "dq_orphans": _on_events(
            lambda e: checks.orphans(
                _broken_tables(e)["fact_events"], "actor_id", _broken_tables(e)["dim_actor"], "actor_id"
            )
        ),
        "grain_check": _on_raw(lambda r: profiles.grain(r, facts.fact_events(r))),
        "fan_out_check": _on_raw(lambda r: profiles.fan_out(r, facts.fact_commits(r))),
        "dimension_sizes": _on_events(
            lambda e: profiles.dimension_sizes(e, {n: t for n, t in _clean_tables(e).items() if n != "fact_events"})
        ),
        "reconcile": _on_events(
            lambda e: profiles.reconcile(e, marts.events_per_repo_per_day(e, dims.dim_repo(e)))
        ),
        "payload_completeness": _on_raw(profiles.payload_completeness),
        "pushes_with_commits": _on_raw(
            lambda r: r.filter((F.col("type") == PUSH) & F.col("payload.commits").isNotNull()).select(
                F.col("id").alias("event_id"), F.array_size("payload.commits").alias("commit_count")
            )
        ),
        "key_skew": _on_events(lambda e: profiles.key_skew(e, "actor_id")),
        "events_with_actor_names": _on_events(_events_with_actor_names),
        "events_with_every_name": _on_events(_events_with_every_name),
        "heavy_keys": _on_events(_heavy_keys),
        "reconcile_content": _content,
        "reconcile_content_swapped": lambda spark, sf_dir: _content(spark, sf_dir, swapped=True),
        "repeated_events": _repeated_events,
        "preview": _on_events(lambda e: profiles.preview(e)),
        "preview_check": _on_events(lambda e: profiles.preview_check(e, "event_id")),
        "contract_report": _on_events(lambda e: profiles.contract_report(e, TABLES["fact_events"])),
        "fact_commits_outer": _on_raw(lambda r: facts.fact_commits(r, keep_empty=True)),
        "events_per_repo_per_day_gappy": _on_events(
            lambda e: marts.events_per_repo_per_day(_gappy_tables(e)["fact_events"], _gappy_tables(e)["dim_repo"])
        ),
        "top_contributors_gappy": _on_events(
            lambda e: marts.top_contributors(_gappy_tables(e)["fact_events"], _gappy_tables(e)["dim_actor"])
        ),
        "dq_report_worse": _on_events(lambda e: checks.report(_worse_tables(e))),
        "ndjson_scan": _ndjson_scan,
        "ndjson_day": _ndjson_day,
        "exported_orc": _exported_orc,
        "daily_bad_lines": _daily_bad_lines,
        "line_health": _line_health,
        "landing_manifest": _landing_manifest,
        "hours_to_fetch": _hours_to_fetch,
        "ledger_hours": _ledger_hours,
        "table_replaced": _table_replaced,
        "day_replaced": _day_replaced,
        "table_from_query": _table_from_query,
        "mart_view": _mart_view,
        "table_moved": _table_moved,
        "exported_parts": _exported_parts,
        **{f"daily_{name}": _published(name) for name in TABLES},
        **{f"lasting_{name}": _lasting(name) for name in MARTS},
        **(llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {}),
    }


# The raw records of activitymill.sources.sample, flat.
_RAW = r"""
WITH src AS (
  SELECT event_id, ts, user_id AS u, event_type AS kind, CAST(regexp_extract(props, '\d+') AS INTEGER) AS k
  FROM events
), raw AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CASE kind WHEN 'purchase' THEN 'PushEvent' WHEN 'click' THEN 'PullRequestEvent'
                   WHEN 'signup' THEN 'IssuesEvent' WHEN 'view' THEN 'WatchEvent'
                   WHEN 'error' THEN 'ForkEvent' END AS event_type,
         date_trunc('second', ts) AS created_ts,
         u AS actor_id,
         concat('dev-', u, CASE WHEN ts >= TIMESTAMP '2024-01-15' AND u % 10 = 0 THEN '-renamed' ELSE '' END)
           AS actor_login,
         u * 5 + k % 5 AS repo_id,
         concat('dev-', u, '/proj-', k % 5,
                CASE WHEN ts >= TIMESTAMP '2024-01-15' AND k % 5 = 0 THEN '-next' ELSE '' END) AS repo_name,
         CASE WHEN k % 3 <> 0 THEN u // 10 END AS org_id,
         CASE WHEN k % 3 <> 0 THEN concat('org-', u // 10) END AS org_login,
         CASE WHEN kind = 'view' THEN 'started'
              WHEN kind IN ('click', 'signup') AND k % 2 = 0 THEN 'opened'
              WHEN kind IN ('click', 'signup') AND k % 5 = 0 THEN 'reopened'
              WHEN kind IN ('click', 'signup') THEN 'closed' END AS action,
         CASE WHEN kind <> 'purchase' OR k % 10 = 0 THEN NULL WHEN k % 10 = 1 THEN 0 ELSE k % 4 + 1 END
           AS commit_count
  FROM src
), fact_events AS (
  SELECT event_id, event_type, actor_id, actor_login, repo_id, repo_name, org_id, org_login, action, created_ts,
         CAST(strftime(created_ts, '%Y%m%d') AS INTEGER) AS date_key
  FROM raw WHERE event_type IN ('PushEvent', 'PullRequestEvent', 'IssuesEvent', 'WatchEvent')
), fact_commits AS (
  SELECT event_id, actor_id, repo_id, CAST(strftime(created_ts, '%Y%m%d') AS INTEGER) AS date_key,
         md5(concat(event_id, '-', i)) AS commit_sha, concat('change ', i, ' of ', event_id) AS commit_message
  FROM raw JOIN generate_series(1, 4) AS s(i) ON i <= commit_count WHERE event_type = 'PushEvent'
), dim_actor AS (
  SELECT actor_id, actor_login FROM fact_events
  QUALIFY row_number() OVER (PARTITION BY actor_id ORDER BY created_ts DESC, actor_login DESC) = 1
), dim_repo AS (
  SELECT repo_id, repo_name, split_part(repo_name, '/', 1) AS repo_owner FROM fact_events
  QUALIFY row_number() OVER (PARTITION BY repo_id ORDER BY created_ts DESC, repo_name DESC) = 1
), dim_org AS (
  SELECT org_id, org_login FROM fact_events WHERE org_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY org_id ORDER BY created_ts DESC, org_login DESC) = 1
), dim_time AS (
  SELECT DISTINCT date_key, CAST(CAST(created_ts AS DATE) AS VARCHAR) AS date,
         CAST(year(created_ts) AS INTEGER) AS year, CAST(month(created_ts) AS INTEGER) AS month,
         CAST(day(created_ts) AS INTEGER) AS day, CAST(dayofweek(created_ts) + 1 AS INTEGER) AS day_of_week
  FROM fact_events
), broken_fact AS (
  SELECT * REPLACE (CASE WHEN event_type = 'WatchEvent' AND actor_id % 10 = 1 THEN NULL ELSE actor_id END
                    AS actor_id) FROM fact_events
), broken_actor AS (
  SELECT * FROM dim_actor WHERE actor_id % 10 <> 7
  UNION ALL SELECT * FROM dim_actor WHERE actor_id % 10 = 3
), broken_repo AS (
  SELECT * REPLACE (CASE WHEN (repo_id // 5) % 10 = 7 THEN NULL ELSE repo_id END AS repo_id) FROM dim_repo
), gappy_fact AS (
  SELECT * REPLACE (CASE WHEN d < 27 THEN 3 WHEN d < 95 THEN actor_id END AS actor_id,
                    CASE WHEN d < 93 THEN repo_id END AS repo_id)
  FROM (SELECT *, CAST(regexp_extract(event_id, '(\d\d?)$', 1) AS INTEGER) AS d FROM fact_events)
), worse_actor AS (
  SELECT * FROM dim_actor UNION ALL SELECT * FROM dim_actor WHERE actor_id % 4 = 0
  UNION ALL SELECT NULL, actor_login FROM dim_actor WHERE actor_id % 4 = 1
), worse_repo AS (
  SELECT * FROM dim_repo UNION ALL SELECT * FROM dim_repo WHERE repo_id % 4 = 0
  UNION ALL SELECT NULL, repo_name, repo_owner FROM dim_repo WHERE repo_id % 4 = 1
), worse_org AS (
  SELECT org_id FROM dim_org UNION ALL SELECT org_id FROM dim_org WHERE org_id % 4 = 0
  UNION ALL SELECT NULL FROM dim_org WHERE org_id % 4 = 1
), worse_time AS (
  SELECT date_key FROM dim_time UNION ALL SELECT date_key FROM dim_time WHERE date_key % 4 = 0
  UNION ALL SELECT NULL FROM dim_time WHERE date_key % 4 = 1
)
"""


def _report_sql(fact: str, actor: str, repo: str, org: str = "dim_org", time: str = "dim_time") -> str:
    def unique(table: str, name: str, key: str) -> str:
        return (f"SELECT 'unique_{name}_{key}' AS check_name, count(*) AS failures FROM (SELECT {key} FROM {table} "
                f"WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)")

    def not_null(table: str, name: str, key: str) -> str:
        return f"SELECT 'not_null_{name}_{key}', count(*) FROM {table} WHERE {key} IS NULL"

    def related(parent: str, name: str, key: str) -> str:
        return (f"SELECT 'relationship_fact_events_{key}_in_{name}', count(*) FROM {fact} AS c WHERE {key} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {parent} AS p WHERE p.{key} = c.{key})")

    keyed = [(actor, "dim_actor", "actor_id"), (repo, "dim_repo", "repo_id"), (org, "dim_org", "org_id"),
             (time, "dim_time", "date_key")]
    parts = [unique(*k) for k in keyed] + [not_null(*k) for k in keyed]
    parts += [not_null(fact, "fact_events", "actor_id")]
    parts += [related(actor, "dim_actor", "actor_id"), related(repo, "dim_repo", "repo_id")]
    return (_RAW + "SELECT check_name, failures, failures <> 0 AS should_warn, failures <> 0 AS should_error FROM ("
            + " UNION ALL ".join(parts) + ")")


def oracle_sql() -> dict[str, str]:
    tables_sql = {
        "fact_events": "SELECT * FROM fact_events",
        "fact_commits": "SELECT * FROM fact_commits",
        "dim_actor": "SELECT * FROM dim_actor",
        "dim_repo": "SELECT * FROM dim_repo",
        "dim_org": "SELECT * FROM dim_org",
        "dim_time": "SELECT * FROM dim_time",
        "events_by_type_per_day":
            "SELECT date_key, event_type, count(*) AS event_count FROM fact_events GROUP BY ALL",
        "events_per_repo_per_day":
            "SELECT date_key, repo_id, dim_repo.repo_name, repo_owner, event_type, count(*) AS event_count "
            "FROM fact_events LEFT JOIN dim_repo USING (repo_id) GROUP BY ALL",
        "pr_throughput":
            "SELECT date_key, action, count(*) AS pr_count FROM fact_events "
            "WHERE event_type = 'PullRequestEvent' GROUP BY ALL",
        "issue_activity":
            "SELECT date_key, action, count(*) AS issue_count FROM fact_events "
            "WHERE event_type = 'IssuesEvent' GROUP BY ALL",
        "top_contributors":
            "SELECT actor_id, dim_actor.actor_login, count(*) AS event_count "
            "FROM fact_events LEFT JOIN dim_actor USING (actor_id) GROUP BY ALL",
    }
    others = {
        "dq_duplicate_keys":
            "SELECT actor_id AS unique_field, count(*) AS n_records FROM broken_actor WHERE actor_id IS NOT NULL "
            "GROUP BY actor_id HAVING count(*) > 1",
        "dq_null_rows": "SELECT * FROM broken_repo WHERE repo_id IS NULL",
        "dq_orphans":
            "SELECT actor_id AS from_field FROM broken_fact WHERE actor_id IS NOT NULL "
            "AND actor_id NOT IN (SELECT actor_id FROM broken_actor)",
        "grain_check":
            "SELECT (SELECT count(*) FROM raw WHERE event_type <> 'ForkEvent') AS raw_events, "
            "(SELECT count(*) FROM fact_events) AS fact_rows, true AS holds",
        "fan_out_check":
            "SELECT count(*) AS pushes, CAST(sum(coalesce(commit_count, 0)) AS BIGINT) AS listed_commits, "
            "(SELECT count(*) FROM fact_commits) AS commit_rows, true AS holds FROM raw WHERE event_type = 'PushEvent'",
        "dimension_sizes":
            "SELECT table_name, row_count, fact_rows, row_count < fact_rows AS smaller FROM ("
            + " UNION ALL ".join(
                f"SELECT '{d}' AS table_name, count(*) AS row_count FROM {d}"
                for d in ("dim_actor", "dim_repo", "dim_org", "dim_time")
            )
            + "), (SELECT count(*) AS fact_rows FROM fact_events)",
        "reconcile":
            "SELECT event_type, count(*) AS fact_count, count(*) AS mart_count, CAST(0 AS BIGINT) AS difference "
            "FROM fact_events GROUP BY event_type",
        "reconcile_content":
            "SELECT date_key, event_type, count(*) AS left_rows, count(*) AS right_rows, false AS differs "
            "FROM fact_events GROUP BY ALL",
        "reconcile_content_swapped":
            "SELECT date_key, event_type, count(*) AS left_rows, count(*) AS right_rows, "
            "bool_or(event_id LIKE '%77') AS differs FROM fact_events GROUP BY ALL",
        "payload_completeness":
            "SELECT count(*) AS pushes, count(*) FILTER (commit_count > 0) AS pushes_with_commits, "
            "count(*) FILTER (commit_count > 0) / count(*) AS share FROM raw WHERE event_type = 'PushEvent'",
        "pushes_with_commits":
            "SELECT event_id, commit_count FROM raw WHERE event_type = 'PushEvent' AND commit_count IS NOT NULL",
        "key_skew":
            "SELECT actor_id, count(*) AS row_count, count(*) / (SELECT count(*) FROM fact_events) AS share "
            "FROM fact_events GROUP BY actor_id",
        "events_with_actor_names":
            "SELECT f.*, d.actor_login AS actor_name FROM (SELECT * EXCLUDE (d) FROM gappy_fact) AS f "
            "LEFT JOIN (SELECT * FROM dim_actor WHERE actor_id % 10 <> 7) AS d ON f.actor_id = d.actor_id",
        "events_with_every_name":
            "SELECT event_id, f.actor_id, any_name FROM gappy_fact AS f "
            "JOIN (SELECT DISTINCT actor_id, actor_login AS any_name FROM fact_events) AS n ON f.actor_id = n.actor_id",
        "heavy_keys": " UNION ALL ".join(
            f"SELECT '{key}' AS key_name, {key} AS key, count(*) AS row_count, "
            f"count(*) / (SELECT count(*) FROM gappy_fact) AS share FROM gappy_fact WHERE {key} IS NOT NULL "
            f"GROUP BY {key} HAVING count(*) >= 0.005 * (SELECT count(*) FROM gappy_fact)"
            for key in ("actor_id", "repo_id", "org_id")
        ),
        "repeated_events":
            "SELECT event_id AS unique_field, count(*) AS n_records FROM ("
            "SELECT event_id, CAST(created_ts AS DATE) AS d FROM fact_events UNION ALL "
            "SELECT event_id, CAST(created_ts AS DATE) + 1 FROM fact_events WHERE event_id LIKE '%77' UNION ALL "
            "SELECT event_id, CAST(created_ts AS DATE) + 1 FROM fact_events WHERE event_id LIKE '%177') "
            "GROUP BY event_id HAVING count(*) > 1 AND max(d) >= DATE '2024-01-16'",
        "ndjson_scan":
            "SELECT CASE WHEN ok THEN event_id END AS id, CASE WHEN ok THEN event_type END AS type, "
            "CASE WHEN ok THEN strftime(created_ts, '%Y-%m-%dT%H:%M:%SZ') END AS created_at, "
            "CASE WHEN ok THEN actor_id END AS actor_id, CASE WHEN ok THEN repo_name END AS repo_name, "
            "CASE WHEN ok THEN org_login END AS org_login, action, commit_count "
            "FROM (SELECT *, event_type <> 'ForkEvent' OR event_id NOT LIKE '%0' AS ok FROM raw)",
        "line_health":
            "SELECT CAST(strftime(created_ts, '%Y%m%d') AS INTEGER) AS landed_day, count(*) AS lines, "
            "count(*) FILTER (event_type = 'ForkEvent' AND event_id LIKE '%0') AS broken_lines, "
            "CAST(0 AS BIGINT) AS misfit_records FROM raw GROUP BY 1",
        "landing_manifest":
            "SELECT strftime(h, '%Y-%m-%d') AS day, CAST(hour(h) AS INTEGER) AS hour, "
            "CASE WHEN h IN (SELECT date_trunc('hour', ts) FROM events) THEN 'ok' ELSE 'missing' END AS status "
            "FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR) AS t(h)",
        "hours_to_fetch":
            "SELECT strftime(h, '%Y-%m-%d') AS day, CAST(hour(h) AS INTEGER) AS hour, "
            "concat(strftime(h, '%Y-%m-%d'), '-', hour(h), '.json.gz') AS file_name "
            "FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR) AS t(h) "
            "WHERE h NOT IN (SELECT date_trunc('hour', ts) FROM events)",
        "ledger_hours":
            "SELECT CAST(strftime(created_ts, '%Y%m%d') AS INTEGER) AS landed_day, "
            "CAST(hour(created_ts) AS INTEGER) AS landed_hour, "
            "CASE WHEN hour(created_ts) >= 20 THEN 'new' WHEN hour(created_ts) = 7 THEN 'changed' ELSE 'same' END AS status, "
            "count(*) FILTER (event_type <> 'ForkEvent' OR event_id LIKE '%0') AS kept_rows FROM raw GROUP BY ALL",
        "table_replaced": tables_sql["fact_events"],
        "exported_orc": tables_sql["fact_events"],
        "preview_check":
            "SELECT least(10, count(*)) AS shown, least(10, count(*)) AS known FROM fact_events",
        "contract_report": "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, '{kind.lower()}' AS declared_type, '{kind.lower()}' AS found_type, "
            f"count({name}) AS filled_rows FROM fact_events"
            for name, kind in (part.split() for part in TABLES["fact_events"].split(", "))
        ) + ")",
        "fact_commits_outer":
            "SELECT * FROM fact_commits UNION ALL SELECT event_id, actor_id, repo_id, "
            "CAST(strftime(created_ts, '%Y%m%d') AS INTEGER), NULL, NULL FROM raw "
            "WHERE event_type = 'PushEvent' AND coalesce(commit_count, 0) = 0",
        "events_per_repo_per_day_gappy":
            "SELECT date_key, f.repo_id, d.repo_name, repo_owner, event_type, count(*) AS event_count FROM gappy_fact AS f "
            "LEFT JOIN (SELECT * FROM dim_repo WHERE repo_id % 10 <> 3) AS d ON f.repo_id = d.repo_id GROUP BY ALL",
        "top_contributors_gappy":
            "SELECT f.actor_id, d.actor_login, count(*) AS event_count FROM gappy_fact AS f "
            "LEFT JOIN (SELECT * FROM dim_actor WHERE actor_id % 10 <> 7) AS d ON f.actor_id = d.actor_id GROUP BY ALL",
        "ndjson_day":
            "SELECT CASE WHEN ok THEN event_id END AS id, CASE WHEN ok THEN event_type END AS type, "
            "CASE WHEN ok THEN strftime(created_ts, '%Y-%m-%dT%H:%M:%SZ') END AS created_at "
            "FROM (SELECT *, event_type <> 'ForkEvent' OR event_id NOT LIKE '%0' AS ok FROM raw) "
            "WHERE CAST(created_ts AS DATE) = DATE '2024-01-15'",
        "daily_bad_lines":
            "SELECT CAST(strftime(created_ts, '%Y%m%d') AS INTEGER) AS landed_day, count(*) AS bad_lines FROM raw "
            "WHERE event_type = 'ForkEvent' AND event_id LIKE '%0' GROUP BY 1",
        "day_replaced":
            "SELECT * REPLACE (CASE WHEN date_key = 20240115 THEN 'again' ELSE action END AS action) FROM fact_events",
        "table_from_query": tables_sql["pr_throughput"],
        "mart_view": tables_sql["issue_activity"],
        "table_moved": tables_sql["issue_activity"],
        "exported_parts": tables_sql["fact_commits"],
    }
    return {
        **{name: _RAW + sql for name, sql in (tables_sql | others).items()},
        **{f"daily_{name}": _RAW + sql for name, sql in tables_sql.items()},
        **{f"lasting_{name}": _RAW + tables_sql[name] for name in MARTS},
        "dq_report": _report_sql("fact_events", "dim_actor", "dim_repo"),
        "dq_report_broken": _report_sql("broken_fact", "broken_actor", "broken_repo"),
        "dq_report_worse": _report_sql("fact_events", "worse_actor", "worse_repo", "worse_org", "worse_time"),
        **(llm.oracle_sql() if llm else {}),
    }
