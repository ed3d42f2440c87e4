"""What every physical plan must look like to hold at scale."""

import os
import re

import pytest

from keelson import plans as library

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")

# Queries that run Spark ML, whose own plans are not ours to shape.
ML = {"als_recommend", "als_facts", "als_for_given_ids"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    # Without small tables to broadcast, the plan is the one that large tables get.
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        yield {name: plan_of(build(spark, FOLDER)) for name, build in library.queries().items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", [n for n in library.queries() if n not in ML])
def test_no_product_joins(plans, name):
    assert "CartesianProduct" not in plans[name]
    assert "BroadcastNestedLoopJoin" not in plans[name]


@pytest.mark.parametrize("name", [n for n in library.queries() if n not in ML])
def test_no_window_over_all_rows(plans, name):
    lines = plans[name].splitlines()
    for i, line in enumerate(lines):
        if re.search(r"[ +:-]Window \[", line):
            assert not any("SinglePartition" in below for below in lines[i + 1: i + 3]), line


@pytest.mark.parametrize("name", [n for n in library.queries() if n not in ML])
def test_broadcasts_are_short_reports(plans, name):
    """The only broadcasts left are those of a top-k."""
    if "BroadcastExchange" in plans[name]:
        assert "TakeOrderedAndProject" in plans[name]


def test_scans_read_only_the_columns_used(plans):
    assert re.search(r"ReadSchema: struct<l_partkey:bigint>", plans["popular_parts"])
    assert re.search(r"ReadSchema: struct<l_linenumber:int>", plans["value_histogram"])
    assert "PushedFilters: [IsNotNull(c_acctbal), LessThan(c_acctbal,0.0)]" in plans["filter_below"]
    assert "GreaterThanOrEqual(o_totalprice,100000.0)" in plans["filter_range_sql"]


def test_no_python_in_the_keyed_queries(plans):
    python = {name for name, plan in plans.items() if re.search(r"MapInPandas|ArrowEvalPython|BatchEvalPython", plan)}
    assert not python


def test_partial_aggregation(plans):
    for name in ("popular_parts", "word_counts", "vertex_degrees", "sum_by_key", "item_pairs"):
        assert "partial_" in plans[name], name
