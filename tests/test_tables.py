import os

import pytest
from pyspark.sql import functions as F

from activitymill.sources import tables
from tests.conftest import rows

SCHEMA = "id INT, date_key INT, landed_day INT"


def stored(spark, path):
    return rows(spark.read.schema(SCHEMA).parquet(path))


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, 20240601, 20240601), (2, 20240602, 20240602), (3, 20240602, 20240602)], SCHEMA)


def test_replace_whole_table(spark, df, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(df, path)
    tables.write_table(df.filter("id = 1"), path)
    assert rows(tables.read_table(spark, path, "parquet")) == [(1, 20240601, 20240601)]


def test_replacing_a_partitioned_table_drops_other_partitions(spark, df, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        tables.write_table(df, path, ["date_key"])
        tables.write_table(df.filter("id = 1"), path, ["date_key"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert stored(spark, path) == [(1, 20240601, 20240601)]


def test_replacing_one_day_leaves_the_others(spark, df, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitions(df, path, ["date_key"])
    tables.write_partitions(df.filter("id = 3"), path, ["date_key"])
    assert stored(spark, path) == [(1, 20240601, 20240601), (3, 20240602, 20240602)]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_format_is_a_parameter(spark, df, tmp_path, fmt):
    path = str(tmp_path / fmt)
    tables.write_table(df, path, fmt=fmt, options={"compression": "gzip" if fmt == "json" else "zlib"}
                       if fmt != "parquet" else {"compression": "snappy"})
    assert rows(tables.read_table(spark, path, fmt).select("id")) == [(1,), (2,), (3,)]


def test_options_reach_the_connector(df):
    with pytest.raises(Exception, match="(?i)no.such.connector"):
        tables.write_table(df, None, fmt="no.such.connector", options={"table": "a.b"})


def test_table_from_query_and_view(spark, df):
    tables.create_table_as(df, "made")
    tables.create_table_as(df.filter("id > 1"), "made")
    assert rows(tables.read_table(spark, "made").select("id")) == [(2,), (3,)]
    tables.create_view(df.filter("id = 1"), "seen")
    tables.create_view(df.filter("id = 2"), "seen")
    assert rows(tables.read_table(spark, "seen").select("id")) == [(2,)]


def test_only_a_missing_table_counts_as_none(spark, tmp_path):
    assert tables.read_if_exists(spark, str(tmp_path / "none"), SCHEMA) is None
    (tmp_path / "junk").mkdir()
    (tmp_path / "junk" / "x.parquet").write_text("this is not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        tables.read_if_exists(spark, str(tmp_path / "junk"), SCHEMA).collect()


class TestReplaceDays:
    """A landed day may hold events of several event days; all of what it put in is replaced, nothing else."""

    def test_stray_events_do_not_wipe_the_neighbouring_day(self, spark, tmp_path):
        path = str(tmp_path / "t")
        day1 = spark.createDataFrame([(1, 20240601, 20240601)], SCHEMA)
        day2 = spark.createDataFrame([(2, 20240602, 20240602), (3, 20240601, 20240602)], SCHEMA)
        tables.replace_days(day1, path, (20240601, 20240601), "date_key")
        tables.replace_days(day2, path, (20240602, 20240602), "date_key")
        assert [r[0] for r in stored(spark, path)] == [1, 2, 3]

    def test_a_stray_partition_that_is_gone_is_emptied(self, spark, tmp_path):
        path = str(tmp_path / "t")
        old = spark.createDataFrame([(2, 20240602, 20240602), (3, 20240601, 20240602), (4, None, 20240602)], SCHEMA)
        new = spark.createDataFrame([(5, 20240602, 20240602)], SCHEMA)
        other = spark.createDataFrame([(1, 20240601, 20240601)], SCHEMA)
        tables.replace_days(other, path, (20240601, 20240601), "date_key")
        tables.replace_days(old, path, (20240602, 20240602), "date_key")
        tables.replace_days(new, path, (20240602, 20240602), "date_key")
        assert stored(spark, path) == [(1, 20240601, 20240601), (5, 20240602, 20240602)]

    def test_a_day_without_rows_empties_what_was_there(self, spark, tmp_path):
        path = str(tmp_path / "t")
        both = spark.createDataFrame([(1, 20240601, 20240601), (2, 20240602, 20240602)], SCHEMA)
        tables.replace_days(both, path, (20240601, 20240602))
        tables.replace_days(both.limit(0), path, (20240602, 20240602))
        assert stored(spark, path) == [(1, 20240601, 20240601)]
        tables.replace_days(both.filter("id = 2"), path, (20240602, 20240602))
        assert [r[0] for r in stored(spark, path)] == [1, 2]


def test_a_table_is_replaced_in_one_step_or_not_at_all(spark, df, tmp_path):
    root = str(tmp_path / "moved")
    first = tables.replace_table_as(df.filter("id = 1"), "moved", root)
    assert rows(spark.table("moved").select("id")) == [(1,)]
    broken = df.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        tables.replace_table_as(broken, "moved", root)
    assert rows(spark.table("moved").select("id")) == [(1,)] and os.listdir(root) == [os.path.basename(first)]
    began = spark.newSession().table("moved")  # a reader that has begun keeps its rows
    second = tables.replace_table_as(df, "moved", root)
    assert rows(spark.table("moved").select("id")) == [(1,), (2,), (3,)]
    assert rows(spark.newSession().table("moved").select("id")) == [(1,), (2,), (3,)]
    assert rows(began.select("id")) == [(1,)]
    third = tables.replace_table_as(df.filter("id = 2"), "moved", root)
    assert sorted(os.listdir(root)) == sorted(os.path.basename(f) for f in (second, third))


def test_a_table_may_be_replaced_by_a_query_on_itself(spark, df, tmp_path):
    root = str(tmp_path / "itself")
    tables.replace_table_as(df, "itself", root)
    for _ in range(3):
        tables.replace_table_as(spark.table("itself").withColumn("id", F.col("id") + 1), "itself", root)
    assert rows(spark.table("itself").select("id")) == [(4,), (5,), (6,)]


def test_another_schema_is_refused_unless_asked_for(spark, df, tmp_path):
    root = str(tmp_path / "it's")
    tables.replace_table_as(df, "columns_change", root)
    with pytest.raises(tables.SchemaChange):
        tables.replace_table_as(df.drop("id"), "columns_change", root)
    assert spark.table("columns_change").columns == df.columns and len(os.listdir(root)) == 1
    tables.replace_table_as(df.drop("id"), "columns_change", root, new_columns=True)
    assert rows(spark.table("columns_change")) == rows(df.drop("id"))
    tables.replace_table_as(df.limit(0).drop("id"), "columns_change", root, fmt="orc", new_columns=True)
    assert rows(spark.table("columns_change")) == []
