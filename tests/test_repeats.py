"""Keys repeated over days, found by the filters of the days."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from activitymill.operators import repeats
from tests.conftest import rows

SCHEMA = "event_id STRING, day INT, level STRING, bitmap INT"


@pytest.fixture(scope="module")
def data(spark):
    """Days of very different sizes; some keys again a day later, one in a third of all rows, some null."""
    rng = random.Random(3)
    made = []
    for day, n in enumerate([3000, 1, 40, 20_000, 0, 500]):
        for i in range(n):
            key = None if rng.random() < 0.01 else "hot" if rng.random() < 0.33 else f"{day}-{i}"
            made.append((key, day, "x", 1))
            if key and rng.random() < 0.02:
                made.append((key, day + rng.randrange(3), "x", 2))
    return spark.createDataFrame(made, SCHEMA).repartition(8).cache()


def exact(old, new):
    counts, wanted = Counter(r.event_id for r in old + new), {r.event_id for r in new}
    return sorted((k, n) for k, n in counts.items() if k is not None and n > 1 and k in wanted)


# Filters of one bit a row name nearly every key, and give the same result.
@pytest.mark.parametrize("since, bits", [(0, 32), (3, 32), (4, 1), (9, 32)])
def test_repeats_equal_counting_all_rows(data, since, bits):
    old, new = data.filter(F.col("day") < since), data.filter(F.col("day") >= since)
    found = repeats.repeated_keys(new, old, repeats.key_filters(old, "event_id", ["day"], bits), "event_id")
    assert sorted(map(tuple, found.collect())) == exact(old.collect(), new.collect())


def test_filters_hold_their_keys_and_few_others(spark, data):
    filters = repeats.key_filters(data, "event_id", ["day"]).cache()
    held = data.filter("event_id IS NOT NULL").select("event_id", "day").distinct()
    assert held.join(repeats.candidates(data, filters, "event_id"), ["event_id", "day"], "left_anti").count() == 0
    others = spark.range(100_000).select(F.concat(F.lit("no-"), "id").alias("event_id"))
    wrong = repeats.candidates(others, filters.filter("day = 3"), "event_id").count()
    assert wrong < 30  # 6 expected at a full load


def test_filters_grow_with_their_day(data):
    filters = repeats.key_filters(data, "event_id", ["day"], bits_per_row=512)
    levels = dict(rows(filters.select("day", "level").distinct()))
    assert levels[1] == 6 and levels[3] == 9  # 20,000 rows of 512 bits are over 256 blocks
    assert filters.filter(F.length("bitmap") != repeats.BLOCK_BITS // 8).count() == 0


def test_stored_filters_of_days_add_up(spark, data, tmp_path):
    path = str(tmp_path / "filters")
    for day in (0, 3):
        filters = repeats.key_filters(data.filter(F.col("day") == day), "event_id", ["day"])
        filters.write.mode("append").partitionBy("day").parquet(path)
    old, new = data.filter("day IN (0, 3)"), data.filter("day NOT IN (0, 3)")
    found = repeats.repeated_keys(new, old, spark.read.parquet(path), "event_id")
    assert sorted(map(tuple, found.collect())) == exact(old.collect(), new.collect())


def test_no_rows_and_only_nulls(spark, data):
    none = spark.createDataFrame([], SCHEMA)
    nulls = spark.createDataFrame([(None, 1, "x", 1)] * 3, SCHEMA)
    for old in (none, nulls):
        filters = repeats.key_filters(old, "event_id", ["day"])
        assert filters.count() == 0
        assert rows(repeats.repeated_keys(nulls, old, filters, "event_id")) == []
        assert rows(repeats.candidates(data, filters, "event_id")) == []
    no_day = spark.createDataFrame([("a", None, "x", 1), (None, None, "x", 1)], SCHEMA)
    filters = repeats.key_filters(no_day, "event_id", ["day"])
    again = spark.createDataFrame([("a", 7, "x", 1)], SCHEMA)
    assert filters.count() == 0
    assert rows(repeats.repeated_keys(again, no_day, filters, "event_id")) == [("a", 2)]


def test_rows_of_earlier_days_are_not_shuffled(spark, data, tmp_path):
    path = str(tmp_path / "old")
    data.filter("day < 5").write.partitionBy("day").parquet(path)
    old = spark.read.parquet(path)
    filters = repeats.key_filters(old, "event_id", ["day"])
    filters.write.parquet(str(tmp_path / "filters"))
    new = data.filter("day >= 5")
    found = repeats.known_rows(new, old, spark.read.parquet(str(tmp_path / "filters")), "event_id")
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    joins = [line for line in plan.splitlines() if "LeftSemi" in line]
    assert joins and all("BroadcastHashJoin" in j for j in joins)
