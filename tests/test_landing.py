import os

from pyspark.sql import functions as F

from activitymill.operators import profiles
from activitymill.plans import daily
from activitymill.sources import landing, sample
from tests.conftest import rows

DAY = "2024-06-02"


def touch(folder, name, size):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(os.urandom(size))


def test_day_glob_takes_either_form_of_the_day():
    assert landing.day_glob("/data/", "20240602") == "/data/2024-06-02-*.json.gz"
    assert landing.day_glob("/data", "2024-06-02") == "/data/2024-06-02-*.json.gz"


def test_manifest_lists_every_hour_once(spark, tmp_path):
    touch(tmp_path, f"{DAY}-0.json.gz", 5000)
    touch(tmp_path, f"{DAY}-1.json.gz", 1024)
    touch(tmp_path, f"{DAY}-2.json.gz", 1023)
    touch(tmp_path, f"{DAY}-03.json.gz", 5000)  # hours are not padded
    touch(tmp_path, f"{DAY}-24.json.gz", 5000)  # no such hour
    touch(tmp_path, "2024-06-03-5.json.gz", 5000)  # another day
    touch(tmp_path, f"{DAY}-4.json.gz.part", 5000)  # not finished
    touch(tmp_path, f"copy-of-{DAY}-5.json.gz", 5000)  # another name
    touch(tmp_path, "2024-06-99-5.json.gz", 5000)  # no such day
    touch(tmp_path, f"{DAY}-23.json.gz/part-0.gz", 700)  # an hour in parts
    touch(tmp_path, f"{DAY}-23.json.gz/part-1.gz", 700)
    manifest = landing.landing_manifest(spark, str(tmp_path), "20240602")
    got = {r.hour: (r.status, r.bytes) for r in manifest.collect()}
    missing = {h: ("missing", None) for h in range(24) if h not in (0, 1, 2, 23)}
    assert got == missing | {0: ("ok", 5000), 1: ("ok", 1024), 2: ("stub", 1023), 23: ("ok", 1400)}


def test_manifest_spans_days(spark, tmp_path):
    touch(tmp_path, "2024-02-29-7.json.gz", 2000)
    manifest = landing.landing_manifest(spark, str(tmp_path), "2024-02-28", "2024-03-01")
    assert manifest.count() == 72
    assert [(str(r.day), r.hour) for r in manifest.filter("status = 'ok'").collect()] == [("2024-02-29", 7)]


def test_nothing_landed_yet(spark, tmp_path):
    manifest = landing.landing_manifest(spark, str(tmp_path), DAY)
    assert rows(manifest.groupBy("status").count()) == [("missing", 24)]
    assert landing.hours_to_fetch(spark, str(tmp_path), DAY).count() == 24


def test_hours_to_fetch_shrink_as_hours_land(spark, tmp_path):
    touch(tmp_path, f"{DAY}-0.json.gz", 1025)
    touch(tmp_path, f"{DAY}-1.json.gz", 1024)  # not above the limit: fetched again
    touch(tmp_path, f"{DAY}-2.json.gz", 100)
    needed = landing.hours_to_fetch(spark, str(tmp_path), DAY)
    assert sorted(r.hour for r in needed.collect()) == list(range(1, 24))
    for name in [r.file_name for r in needed.collect()]:
        touch(tmp_path, name, 2000)
    assert landing.hours_to_fetch(spark, str(tmp_path), DAY).count() == 0


def test_paths_survive_odd_folder_names(spark, tmp_path, write_hour):
    folder = tmp_path / "a b+c%20d"
    write_hour(folder, f"{DAY}-0", ['{"id":"1","type":"WatchEvent"}'])
    path = landing.landing_manifest(spark, str(folder), DAY).filter("status = 'ok'").first().path
    assert landing.scan_events(spark, [path]).filter("type = 'WatchEvent'").count() == 1


def test_scan_reads_one_day(spark, tmp_path, write_hour):
    write_hour(tmp_path, f"{DAY}-0", ['{"id":"1","type":"WatchEvent"}'], valid=False)
    write_hour(tmp_path, f"{DAY}-13", ['{"id":"2","type":"PushEvent"}'], valid=False)
    write_hour(tmp_path, "2024-06-03-0", ['{"id":"3","type":"PushEvent"}'], valid=False)
    raw = landing.scan_events(spark, landing.day_glob(str(tmp_path), DAY))
    assert rows(raw, "id", "type") == [("1", "WatchEvent"), ("2", "PushEvent")]


def test_bad_lines_are_kept_with_their_day(spark, tmp_path, write_hour):
    write_hour(tmp_path, f"{DAY}-0", [
        '{"id":"1","type":"WatchEvent"}', '{"id":"2","type":', '{"id":"3","type":"PushEvent","actor":{"id":"x"}}',
    ], valid=False)
    write_hour(tmp_path, "2024-06-03-1", ["junk"], valid=False)
    scanned = landing.scan_events(spark, f"{tmp_path}/*.json.gz", with_source=True)
    bad = scanned.filter(F.col("bad_line").isNotNull())
    assert rows(bad, "landed_day", "bad_line") == [
        (20240602, '{"id":"2","type":'),
        (20240602, '{"id":"3","type":"PushEvent","actor":{"id":"x"}}'),
        (20240603, "junk"),
    ]
    assert rows(profiles.line_health(scanned)) == [(20240602, 3, 1, 1), (20240603, 1, 1, 0)]


def test_a_file_of_another_name_has_no_day(spark, tmp_path):
    (tmp_path / "events.json").write_text('{"id":"1"}')
    assert rows(landing.scan_events(spark, str(tmp_path), with_source=True), "id", "landed_day") == [("1", None)]


def test_listing_reads_no_content_and_skips_other_days(spark, tmp_path):
    for day in range(1, 29):
        touch(tmp_path, f"2024-02-{day:02d}-0.json.gz", 2000)
    hours = landing.landed_hours(spark, str(tmp_path), "2024-02-09", "2024-02-11")
    assert "ReadSchema: struct<>" in hours._jdf.queryExecution().executedPlan().toString()
    assert hours.count() == 3
    # Make every file a task of its own: those of other days get none.
    sizes = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "1000"}
    try:
        for key, value in sizes.items():
            spark.conf.set(key, value)
        listed = landing.hour_files(spark, str(tmp_path), "2024-02-09", "2024-02-11")
        assert listed.rdd.getNumPartitions() == 3
    finally:
        for key in sizes:
            spark.conf.unset(key)


def test_files_do_not_grow_with_tasks(spark, tmp_path):
    """An hour's records are in one file however many tasks make them, and parsed rows not in a file per task and day."""
    raw = spark.range(960).repartition(8).selectExpr(
        "cast(id as string) as id", "'PushEvent' as type",
        "concat('2024-06-0', cast(id % 4 + 1 as string), 'T0', cast(id % 3 as string), ':00:00Z') as created_at",
        "named_struct('id', id, 'login', 'a') as actor", "named_struct('id', id, 'name', 'a/b') as repo",
        "cast(null as struct<id: bigint, login: string>) as org",
        "cast(null as struct<action: string, commits: array<struct<sha: string, message: string>>>) as payload",
    )
    sample.land(raw, str(tmp_path / "landing"))
    assert len(list((tmp_path / "landing").glob("hour_file=*/*.gz"))) == 12
    staged = daily.stage(spark, [str(tmp_path / "landing" / "*")], str(tmp_path / "staged"))
    assert len(list((tmp_path / "staged").rglob("*.parquet"))) <= 12
    assert not list((tmp_path / "staged").glob("landed_day=*"))
    got = {r.landed_day: r["count"] for r in staged.groupBy("landed_day").count().collect()}
    assert got == {20240601 + d: 240 for d in range(4)}
