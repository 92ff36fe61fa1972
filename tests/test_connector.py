import os

import pytest
from pyspark.sql import functions as F

from activitymill.contract import TABLES, columns
from activitymill.plans import daily
from activitymill.sources import connector, tables
from tests.conftest import rows
from tests.test_daily import DAY1, DAY2, from_scratch, landing, run  # noqa: F401

SCHEMA = "id LONG, name STRING, at TIMESTAMP, parts ARRAY<STRUCT<a: INT, b: STRING>>"


@pytest.fixture(autouse=True)
def known(spark):
    connector.register(spark)


def some(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}" if i % 3 else None, None, [(i, "x")] if i % 2 else None) for i in ids], SCHEMA)


def write(df, path, mode="overwrite"):
    df.write.format("parts").mode(mode).option("path", str(path)).save()


def stored(path):
    return sorted(f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_what_was_written_is_read_back(spark, tmp_path):
    df = some(spark, *range(500)).withColumn("at", F.timestamp_seconds("id")).repartition(3)
    tables.write_table(df, None, fmt="parts", options={"path": str(tmp_path)})
    read = tables.read_table(spark, str(tmp_path), "parts")
    assert read.dtypes == df.dtypes and rows(read) == rows(df) and len(stored(tmp_path)) == 3
    assert rows(read.select("name").distinct()) == rows(df.select("name").distinct())


def test_overwrite_replaces_and_append_adds(spark, tmp_path):
    write(some(spark, 1, 2), tmp_path)
    write(some(spark, 3), tmp_path, "append")
    assert rows(spark.read.format("parts").load(str(tmp_path)), "id") == [(1,), (2,), (3,)]
    write(some(spark, 4), tmp_path)
    write(some(spark, 5), tmp_path)
    assert rows(spark.read.format("parts").load(str(tmp_path)), "id") == [(5,)]
    assert len(stored(tmp_path)) <= 4  # those of this list and of the one before


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    write(some(spark, 1, 2), tmp_path)
    before = stored(tmp_path)
    # Most tasks are done, or have begun to write, when one fails.
    broken = spark.range(0, 40_000, 1, 8).select(
        "id", F.when(F.col("id") == 39_999, F.raise_error(F.lit("broken"))).otherwise("x").alias("name"),
        F.lit(None).cast("timestamp").alias("at"), F.lit(None).cast("array<struct<a:int,b:string>>").alias("parts"))
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception, match="broken"):
            write(broken, tmp_path, mode)
        assert stored(tmp_path) == before
        assert rows(spark.read.format("parts").load(str(tmp_path)), "id") == [(1,), (2,)]


def test_a_commit_that_fails_leaves_nothing(spark, tmp_path):
    write(some(spark, 1), tmp_path)
    with pytest.raises(Exception, match="another schema"):
        write(spark.range(3), tmp_path, "append")
    assert rows(spark.read.format("parts").load(str(tmp_path)), "id") == [(1,)] and len(stored(tmp_path)) == 1


def test_files_of_other_attempts_are_not_read(spark, tmp_path):
    write(some(spark, 1), tmp_path)
    (tmp_path / "lost").mkdir()
    (tmp_path / "lost" / "000000-9.parquet").write_bytes(b"cut off")
    assert rows(spark.read.format("parts").load(str(tmp_path)), "id") == [(1,)]


def test_no_rows(spark, tmp_path):
    write(some(spark, 1).limit(0), tmp_path)
    read = spark.read.format("parts").load(str(tmp_path))
    assert read.dtypes == some(spark, 1).dtypes and read.collect() == []
    with pytest.raises(Exception, match="nothing was written"):
        spark.read.format("parts").load(str(tmp_path / "nowhere"))


def test_published_tables_are_exported(spark, landing, tmp_path):  # noqa: F811
    root, other = tmp_path / "house", tmp_path / "other"
    run(spark, landing, root, DAY1, DAY2)
    daily.export(daily.Warehouse(spark, str(root)), "parts", lambda name: {"path": str(other / name)})
    found = {name: rows(spark.read.format("parts").load(str(other / name)).select(*columns(name))) for name in TABLES}
    assert found == from_scratch(spark, landing)
