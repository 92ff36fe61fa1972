import duckdb
import pytest
from pyspark.sql import functions as F

from activitymill.llm import mixing
from tests.llm import corpus


def run(df, **options):
    return sorted((tuple(r) for r in mixing.mix_sources(df, **options).collect()), key=str)


def test_same_as_sql(spark, tmp_path):
    docs = corpus.documents(spark)
    docs.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    columns = "doc_id, size, source_size, target, taken"
    assert run(docs) == sorted(con.sql(f"select {columns} from ({mixing.ORACLE_SQL})").fetchall(), key=str)


@pytest.mark.parametrize("shard_words", [50, 1 << 19])
def test_takes_come_near_targets_and_stay_below_the_limit(spark, shard_words):
    docs = corpus.documents(spark)
    rows = mixing.mix_sources(docs, shard_words=shard_words, block_words=4).join(
        docs.select("doc_id", "source").distinct(), "doc_id"
    ).collect()
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        shards = -(-own[0].source_size // shard_words)
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.15 * own[0].target + 8 * shards + 300 * (source is not None)
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)


def test_targets_stop_at_the_limit_and_share_the_rest(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 1000), ("d", 1), (None, 500)]
    got = mixing.targets(spark.createDataFrame(sizes, "source string, source_size long"), (5, 2, 1), 1.5, 2)
    target = {r.source: r.target for r in got.collect()}
    # Weights 5, 2, 1, 5, 2: a and d stop at once; the rest of 3744.5 goes 2 : 1 : 2, where null stops at 1000.
    assert target["a"] == 20 and target["d"] == 2 and target[None] == 1000
    assert target["b"] == pytest.approx(2744.5 * 2 / 3) and target["c"] == pytest.approx(2744.5 / 3)


def test_highest_quotients(spark):
    votes = [("a", 53), ("b", 24), ("c", 23), ("d", 0)]
    df = spark.createDataFrame(votes, "p string, v long").withColumns(
        {"g": F.lit(1), "seats": F.lit(7), "most": F.lit(99)})
    assert {r.p: r.quota for r in mixing.apportion(df, ["g"], "v", "seats", "most", "p").collect()} == {"a": 3, "b": 2, "c": 2, "d": 0}
    few = df.withColumn("most", F.lit(2))
    assert {r.p: r.quota for r in mixing.apportion(few, ["g"], "v", "seats", "most", "p").collect()}["a"] == 2


def test_reruns_agree_and_an_empty_table_gives_no_rows(spark):
    docs = corpus.documents(spark)
    assert run(docs) == run(docs.repartition(3, "text"))
    assert run(corpus.none(spark)) == []
    blank = docs.filter("text is null or trim(text) = ''")
    assert {r[4] for r in run(blank)} == {0}


def test_no_python_in_the_plan(spark):
    plan = mixing.mix_sources(corpus.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
