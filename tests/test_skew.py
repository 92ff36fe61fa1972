import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from activitymill.operators import skew
from tests.conftest import rows

SCHEMA = "event INT, day INT, k BIGINT, salt STRING"


@pytest.fixture(scope="module")
def fact(spark):
    rng = random.Random(1)
    values = [(i, i % 5, 3 if i % 100 < 27 else 4 if i % 100 < 32 else None if i % 100 < 40 else rng.randrange(10, 4000), "s")
              for i in range(20_000)]
    return spark.createDataFrame(values, SCHEMA).repartition(8).cache()


def exact(df, share):
    counts = Counter(r.k for r in df.collect())
    total = sum(counts.values())
    return [(k, n, n / total) for k, n in counts.items() if k is not None and n >= share * total]


@pytest.mark.parametrize("share", [0.2, 0.01, 0.0005])
def test_heavy_keys_are_exact(fact, share):
    assert rows(skew.heavy_keys(fact, "k", share)) == rows_like(exact(fact, share))


def rows_like(values):
    return sorted(values, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_stored_sketches_of_days_add_up(spark, fact, tmp_path):
    path = str(tmp_path / "sketches")
    skew.key_sketches(fact, "k", ["day"]).write.partitionBy("day").parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 5
    assert rows(skew.heavy_keys(fact, "k", 0.01, stored)) == rows_like(exact(fact, 0.01))
    some = stored.filter("day < 2")
    part = fact.filter("day < 2")
    assert rows(skew.heavy_keys(part, "k", 0.01, some)) == rows_like(exact(part, 0.01))


def test_what_is_shuffled_does_not_grow_with_the_keys(spark, fact):
    df = fact.withColumn("k", F.when(F.col("event") % 10 == 0, 3).otherwise(F.col("event")))
    found = skew.heavy_keys(df, "k", 0.05)
    assert [r.k for r in found.collect()] == [3]
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Only counted candidates are dealt by key; the sketch and the total are one row a task.
    assert plan.count("hashpartitioning") <= 2 and "SortMergeJoin" not in plan


def test_no_rows_and_only_nulls(spark):
    none = spark.createDataFrame([], SCHEMA)
    nulls = spark.createDataFrame([(1, 1, None, "s")] * 3, SCHEMA)
    names = spark.createDataFrame([(1, "one")], "k BIGINT, name STRING")
    assert rows(skew.heavy_keys(none, "k")) == [] and rows(skew.heavy_keys(nulls, "k")) == []
    assert rows(skew.split_join(none, names, "k")) == []
    assert rows(skew.split_join(nulls, names, "k"), "event", "name") == [(1, None)] * 3
    assert rows(skew.split_join(nulls, names, "k", "inner")) == []


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("options", [{}, {"share": 0.2}, {"share": 0.9}, {"most_heavy": 0}, {"share": 0.2, "most_heavy": 1}])
def test_equals_a_plain_join(spark, fact, how, options):
    """With keys that are unknown, null, heavy, and there more than once."""
    names = spark.createDataFrame(
        [(k, f"n{k}", k % 7) for k in range(4000) if k % 9] + [(3, "again", 1), (20, "again", 2), (None, "none", 3)],
        "k BIGINT, name STRING, salt_ INT")
    got = skew.split_join(fact, names, "k", how, **options)
    want = fact.join(names, "k", how).select(*got.columns)
    assert got.columns == ["event", "day", "k", "salt", "name", "salt_"] and rows(got) == rows(want)


def test_a_key_with_a_quarter_of_the_rows_is_no_large_task(spark, fact):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = spark.range(4000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))

        def tasks(df):
            return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("t")).count().collect())

        plain, split = (tasks(j.select("event", "name")) for j in (
            fact.join(names, "k", "left"), skew.split_join(fact, names, "k")))
        assert sum(plain) == sum(split) == 20_000
        assert plain[-1] > 2 * plain[len(plain) // 2] and split[-1] <= 2 * split[len(split) // 2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_other_joins_are_refused(fact):
    with pytest.raises(ValueError, match="left or inner"):
        skew.split_join(fact, fact, "k", "full")
