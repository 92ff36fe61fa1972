"""The ledger of landed hours: what is parsed again and what is not."""

import gzip
import os
import shutil

import pytest
from pyspark.sql import functions as F

from activitymill.plans import daily
from activitymill.plans.daily import Warehouse, hour_ledger, run_days
from activitymill.sources import landing
from tests.conftest import rows
from tests.test_contract import line

DAY, NEXT = "2024-06-02", "2024-06-03"


def land(folder, hour_name, *ids):
    """One event per id, as an hour; not compressed inside, so that its size only depends on how long the ids are."""
    folder.mkdir(parents=True, exist_ok=True)
    text = "".join(line(i, "WatchEvent", at=f"{hour_name[:10]}T05:00:00Z") + "\n" for i in ids)
    (folder / f"{hour_name}.json.gz").write_bytes(gzip.compress(text.encode(), compresslevel=0, mtime=0))


def hours(spark, folder, *days):
    manifest = landing.landing_manifest(spark, str(folder), *(days or (DAY,)), min_bytes=1)
    return sorted(manifest.filter("status = 'ok'").collect(), key=lambda h: (h.day, h.hour))


def statuses(found):
    return {h.hour: h.status for h in found}


def test_only_new_and_changed_hours_are_parsed(spark, tmp_path):
    folder, parsed = tmp_path / "in", []
    ledger = hour_ledger(spark, str(tmp_path / "ledger"))
    parse = ledger.parse
    ledger.parse = lambda paths, to: (parsed.append(sorted(os.path.basename(p) for p in paths)), parse(paths, to))
    for hour in range(3):
        land(folder, f"{DAY}-{hour}", f"a{hour}")
    first = ledger.update(hours(spark, folder))
    assert set(statuses(first).values()) == {"new"} and len(parsed.pop()) == 3
    land(folder, f"{DAY}-7", "late")
    land(folder, f"{DAY}-1", "b1")  # another event, as long as the one before
    os.utime(folder / f"{DAY}-1.json.gz", (2e9, 2e9))
    second = ledger.update(hours(spark, folder))
    assert statuses(second) == {0: "same", 1: "changed", 2: "same", 7: "new"}
    assert parsed == [[f"{DAY}-1.json.gz", f"{DAY}-7.json.gz"]]
    assert rows(ledger.rows(second), "event_id", "landed_hour") == [("a0", 0), ("a2", 2), ("b1", 1), ("late", 7)]
    assert rows(ledger.rows(first), "event_id") == [("a0",), ("a1",), ("a2",)]  # for one more run
    assert rows(ledger.rows(second[3:]), "event_id") == [("late",)]


def test_equal_content_is_never_parsed_again(spark, tmp_path, monkeypatch):
    folder, ledger = tmp_path / "in", hour_ledger(spark, str(tmp_path / "ledger"))
    land(folder, f"{DAY}-0", "a")
    (folder / f"{DAY}-1.json.gz").mkdir()  # an hour in parts
    for part in ("x", "y"):
        land(tmp_path / part, f"{DAY}-1", part)
        shutil.copy(tmp_path / part / f"{DAY}-1.json.gz", folder / f"{DAY}-1.json.gz" / f"{part}.gz")
    first = ledger.update(hours(spark, folder))
    shutil.copytree(folder, tmp_path / "moved copy+%20")  # other paths and times
    shutil.move(tmp_path / "moved copy+%20" / f"{DAY}-1.json.gz" / "x.gz", tmp_path / "moved copy+%20" / f"{DAY}-1.json.gz" / "z.gz")
    os.utime(tmp_path / "moved copy+%20" / f"{DAY}-0.json.gz", (1e9, 1e9))
    again = ledger.update(hours(spark, tmp_path / "moved copy+%20"))
    assert set(statuses(again).values()) == {"same"}
    assert [h.run for h in again] == [h.run for h in first]
    assert rows(ledger.rows(again), "event_id") == [("a",), ("x",), ("y",)]
    # The new times are known now, so nothing has to be hashed any more.
    from activitymill.sources import ledger as module
    monkeypatch.setattr(module, "digests", lambda spark, paths: pytest.fail("read") if paths else {})
    assert set(statuses(ledger.update(hours(spark, tmp_path / "moved copy+%20"))).values()) == {"same"}


def test_a_change_of_equal_size_and_time_is_noticed_when_asked(spark, tmp_path):
    folder, ledger = tmp_path / "in", hour_ledger(spark, str(tmp_path / "ledger"))
    for name in ("a", "b"):
        land(folder, f"{DAY}-0", name)
        os.utime(folder / f"{DAY}-0.json.gz", (1.7e9, 1.7e9))
        found = ledger.update(hours(spark, folder))
    assert statuses(found) == {0: "same"} and rows(ledger.rows(found), "event_id") == [("a",)]
    found = ledger.update(hours(spark, folder), verify=True)
    assert statuses(found) == {0: "changed"} and rows(ledger.rows(found), "event_id") == [("b",)]


def test_a_run_that_breaks_off_leaves_the_ledger(spark, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "ledger"
    land(folder, f"{DAY}-0", "a")
    first = hour_ledger(spark, str(root)).update(hours(spark, folder))
    land(folder, f"{DAY}-1", "b")
    broken = hour_ledger(spark, str(root))
    broken.parse = lambda paths, to: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        broken.update(hours(spark, folder))
    (root / "entries" / "99").mkdir()  # entries that were not finished
    ledger = hour_ledger(spark, str(root))
    assert rows(ledger.entries(), "run") == [(first[0].run,)]
    assert statuses(ledger.update(hours(spark, folder))) == {0: "same", 1: "new"}


def test_replaced_rows_go_one_run_later(spark, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "ledger"
    ledger, runs = hour_ledger(spark, str(root)), []
    for i in range(4):
        land(folder, f"{DAY}-0", f"event{'x' * i}")
        runs.append(ledger.update(hours(spark, folder))[0].run)
        kept = {p.parent.parent.name.removeprefix("run=") for p in root.glob("hours/run=*/*/*")}
        assert kept == set(runs[-2:])
    assert len(list(root.glob("entries/*"))) == 2


def test_no_hours_and_hours_without_rows(spark, tmp_path):
    folder, ledger = tmp_path / "in", hour_ledger(spark, str(tmp_path / "ledger"))
    assert ledger.update([]) == [] and rows(ledger.rows([])) == [] and rows(ledger.entries()) == []
    land(folder, f"{DAY}-0")
    found = ledger.update(hours(spark, folder))
    assert statuses(found) == {0: "new"} and rows(ledger.rows(found)) == []
    assert statuses(ledger.update(hours(spark, folder), verify=True)) == {0: "same"}


def test_the_daily_job_parses_a_late_hour_alone(spark, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "house"
    for day in (DAY, NEXT):
        for hour in (0, 1):
            land(folder, f"{day}-{hour}", f"{day}-{hour}")

    def run(root, **more):
        return run_days(spark, DAY, NEXT, landing_dir=str(folder), warehouse=str(root), allow_missing_hours=True,
                        min_hour_bytes=1, **more)

    more = {"ledger": str(tmp_path / "ledger")}
    assert len(run(root, **more).parsed_hours) == 4
    land(folder, f"{DAY}-9", "late1", "late2")
    assert run(root, **more).parsed_hours == [("20240602", 9)]
    assert len(run(tmp_path / "plain").parsed_hours) == 5
    with_ledger, plain = (Warehouse(spark, str(r)) for r in (root, tmp_path / "plain"))
    for name in (*daily.BY_DAY, *daily.MERGED, "top_contributors"):
        assert rows(with_ledger.table(name)) == rows(plain.table(name)), name
    assert with_ledger.table("fact_events").filter(F.col("event_id").startswith("late")).count() == 2
