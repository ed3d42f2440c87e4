"""How long stored tables stay."""

from pathlib import Path

import pytest

from keelson.session import Held, keep, work_dir, working


def folder(path):
    return Path(path.removeprefix("file:"))


def test_a_block_removes_its_tables_and_what_is_held_stays(spark):
    held = Held(spark, "held")
    with working(spark, "outer"):
        outer = folder(work_dir(spark, "probe")).parent
        numbers = keep(spark.range(10), "numbers")
        within = Held(spark, "within")
        with working(spark, "inner"):
            inner = folder(work_dir(spark, "probe")).parent
            assert inner.parent == outer and keep(numbers, "again").count() == 10
            few = within.put(numbers.where("id < 4"))
        assert not inner.exists() and few.count() == 4
        result = held.put(few.where("id > 0"))
    assert not outer.exists()
    assert sorted(r.id for r in result.collect()) == [1, 2, 3]
    assert folder(work_dir(spark, "probe")).parent == folder(held.base).parent


def test_a_block_that_fails_removes_its_tables(spark):
    with pytest.raises(ZeroDivisionError), working(spark, "failing"):
        path = folder(work_dir(spark, "probe")).parent
        keep(spark.range(3), "rows")
        assert path.exists()
        1 / 0
    assert not path.exists()


def test_each_put_replaces_the_table_before(spark):
    held = Held(spark, "rounds")
    rows = held.put(spark.range(5))
    for _ in range(3):
        rows = held.put(rows.selectExpr("id * 2 AS id"))
    assert sorted(r.id for r in rows.collect()) == [0, 8, 16, 24, 32]
    assert [p.name for p in folder(held.base).iterdir()] == ["3"]


def test_an_empty_table_keeps_its_columns(spark):
    rows = Held(spark, "none").put(spark.range(0).selectExpr("id", "'x' AS name"))
    assert rows.columns == ["id", "name"] and rows.count() == 0
