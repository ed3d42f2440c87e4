"""Every named query against its SQL twin, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from keelson.sources import table
from keelson.sources.tables import SCHEMAS
from tests.compare import connect, difference, duck_rows, spark_rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 10
    assert [r.score for r in rows] == sorted((r.score for r in rows), reverse=True)


def test_oracles_name_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, duck, name):
    got = spark_rows(entry.queries()[name](spark, FOLDER))
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got[1]
    else:
        assert difference(got, duck_rows(duck, sql)) is None


def test_query_in_another_time_zone(spark, duck):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("url_windows", "window_counts", "stream_window_counts", "k_fold"):
            got = spark_rows(entry.queries()[name](spark, FOLDER))
            assert difference(got, duck_rows(duck, entry.oracle_sql()[name])) is None, name
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("name", SCHEMAS)
def test_declared_schemas_are_those_of_the_files(spark, name):
    stored = spark.read.parquet(f"{FOLDER}/{name}.parquet").dtypes
    assert table(spark, FOLDER, name).dtypes == stored
