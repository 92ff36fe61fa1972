from graphlib import CycleError

import pytest

from activitymill.contract import MARTS, TABLES, columns
from activitymill.plans import daily
from activitymill.sources import views
from tests.conftest import rows
from tests.test_daily import DAY1, DAY2, from_scratch, hours_of, landing, run  # noqa: F401


def test_order_follows_what_texts_need():
    texts = {"a": "SELECT * FROM {b} JOIN {c}", "b": "SELECT * FROM {c}", "c": "SELECT 1 AS x", "d": "SELECT * FROM {given}"}
    order = views.in_order(texts)
    assert sorted(order) == list("abcd") and order.index("c") < order.index("b") < order.index("a")
    with pytest.raises(CycleError):
        views.in_order({"a": "{b}", "b": "{a}"})


def test_views_on_views_outlast_their_session(spark):
    texts = {"evens": "SELECT id FROM {numbers} WHERE id % 2 = 0", "numbers": "SELECT id FROM range(10)",
             "sum": "SELECT sum(id) AS n FROM {evens}"}
    assert views.create_views(spark.newSession(), "lasting", texts)[0] == "numbers"
    later = spark.newSession()
    assert later.table("lasting.sum").first().n == 20
    views.create_views(spark, "lasting", {"evens": "SELECT id FROM {numbers} WHERE id < 3"}, known=["numbers"])
    assert later.table("lasting.sum").first().n == 3


def test_unknown_names_stop_before_anything_is_created(spark):
    with pytest.raises(KeyError, match="b needs nowhere"):
        views.create_views(spark, "not_made", {"a": "SELECT 1 AS x", "b": "SELECT * FROM {nowhere}"})
    assert not spark.catalog.databaseExists("not_made")


def test_odd_names(spark, tmp_path):
    path = str(tmp_path / "a `c` 'd'")
    spark.range(3).write.parquet(path)
    views.create_views(spark, "odd_db", {"v": views.folder(spark, path, "id INT")})
    assert rows(spark.table("odd_db.v")) == [(0,), (1,), (2,)] and spark.table("odd_db.v").dtypes == [("id", "int")]


def test_a_second_session_reads_all_tables_by_name(spark, landing, tmp_path, write_hour):  # noqa: F811
    root = tmp_path / "house"
    run(spark, landing, root, DAY1, database="activity")
    later = spark.newSession()
    first = {name: rows(later.table(f"activity.{name}")) for name in MARTS}
    run(spark, landing, root, DAY2, database="activity")
    want = from_scratch(spark, landing)
    got = {name: rows(spark.newSession().table(f"activity.{name}").select(*columns(name))) for name in TABLES}
    assert got == want and {name: want[name] for name in MARTS} != first
    # A corrected day, and a table that has no rows.
    write_hour(tmp_path / "in", f"{DAY2}-0", hours_of(DAY2, [3], actor=(1, "ann3")))
    run(spark, landing, root, DAY2, database="activity")
    assert rows(spark.newSession().table("activity.bad_lines")) == []
    assert {name: rows(later.table(f"activity.{name}")) for name in MARTS} == {
        name: from_scratch(spark, landing)[name] for name in MARTS}


def test_view_texts_equal_the_builders(spark, landing, tmp_path):  # noqa: F811
    root = tmp_path / "house"
    run(spark, landing, root, DAY1, DAY2)
    house = daily.Warehouse(spark, str(root))
    daily.lasting_views(house, "again")
    for name, df in daily.build_marts(house, house.state()).items():
        view = spark.table(f"again.{name}")
        assert view.dtypes == df.dtypes and rows(view) == rows(df)


def test_a_warehouse_without_runs(spark, tmp_path):
    daily.lasting_views(daily.Warehouse(spark, str(tmp_path / "none")), "empty")
    assert all(spark.table(f"empty.{name}").count() == 0 for name in TABLES)
