import random

import pytest
from pyspark.sql import functions as F

from keelson.operators import splits


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    # User 1 owns a third of all rows; many rows share a time.
    return [(1 if i % 3 == 0 else rng.randrange(2, 12), rng.randrange(40), i) for i in range(400)]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "user int, ts int, id int").repartition(7).cache()


def test_keys_at_ranks(table, rows):
    ordered = sorted((t, i) for _, t, i in rows)
    ranks = [1, 2, 57, 200, 399, 400, 0, 401]
    n, found = splits.keys_at_ranks(table, ["ts", "id"], lambda n: ranks)
    assert n == 400 and set(found) == {1, 2, 57, 200, 399, 400}
    for rank, key in found.items():
        assert tuple(table.select(key.alias("k")).first().k) == ordered[rank - 1]


@pytest.mark.parametrize("k", [1, 3, 5, 60])
def test_folds(table, rows, k):
    ordered = sorted((t, i) for _, t, i in rows)
    n = len(ordered)
    got = {r.id: r.fold for r in splits.k_fold(table, ["ts", "id"], k).collect()}
    assert len(got) == n
    for fold in range(1, k + 1):
        ids = {i for _, i in ordered[(fold - 1) * n // k: fold * n // k]}
        assert {i for i, f in got.items() if f == fold} == ids


def test_fewer_rows_than_folds(spark):
    df = spark.range(4).select("id")
    assert [r.fold for r in splits.k_fold(df, ["id"], 7).orderBy("id").collect()] == [2, 4, 6, 7]


def test_labelling_folds_moves_no_rows(table):
    plan = splits.k_fold(table, ["ts", "id"], 5)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_folds_of_an_empty_table(table):
    assert splits.k_fold(table.limit(0), ["ts", "id"], 3).count() == 0


@pytest.mark.parametrize("cap", [None, 0, 17, 10_000])
def test_leave_n_out(table, rows, cap):
    seen, test = {}, set()
    for user, _, i in sorted(rows, key=lambda r: r[1:]):
        seen[user] = seen.get(user, 0) + 1
        if 3 <= seen[user] <= 8 and (not cap or len(test) < cap):
            test.add(i)
    got = splits.leave_n_out(table, ["user"], ["ts", "id"], 3, 8, cap).collect()
    assert len(got) == len(rows)
    assert {r.id for r in got if r.part == "test"} == test


def test_hash_split_does_not_depend_on_partitions(table):
    def parts(df, seed):
        return {r.id: r.part for r in splits.hash_split(df, ["id"], [0.5, 0.3, 0.2], seed).collect()}

    first = parts(table, 1)
    assert first == parts(table.repartition(3), 1) != parts(table, 2)
    share = [sum(p == i for p in first.values()) / len(first) for i in range(3)]
    assert share == pytest.approx([0.5, 0.3, 0.2], abs=0.08)


def test_order_keys_of_other_types(spark):
    df = spark.range(50).select(
        F.timestamp_micros(F.lit(1700000000123456) + F.col("id") * 1000001).cast("timestamp_ntz").alias("t"),
        (F.col("id") / 7).alias("d"),
        F.col("id").cast("string").alias("s"),
        "id",
    )
    for order in (["t"], ["d"], ["s"]):
        ids = [r.id for r in df.orderBy(*order).collect()]
        fold = {r.id: r.fold for r in splits.k_fold(df, order, 4).collect()}
        assert [fold[i] for i in ids] == sorted(fold.values())


def test_a_weight_of_zero_gives_an_empty_part(spark):
    df = spark.range(1000)
    for weights in ([1, 0], [0, 1], [1, 0, 1], [1, 1e-12]):
        got = {r.part: r.n for r in splits.hash_split(df, ["id"], weights).groupBy("part").count().toDF("part", "n").collect()}
        assert all(got.get(i, 0) == 0 for i, w in enumerate(weights) if w < 1e-9) and sum(got.values()) == 1000
    for weights in ([0, 0], [-1, 2], []):
        with pytest.raises(ValueError):
            splits.hash_cuts(weights)


def test_folds_over_a_clock_change(spark):
    """240 minutes around the end of summer time: the repeated hour holds 120 of them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        start = 1_730_606_400  # two hours before clocks go back, as seconds
        df = spark.range(240).select(F.timestamp_seconds(F.lit(start) + F.col("id") * 60).alias("t"))
        folds = splits.k_fold(df, ["t"], 4).groupBy("fold").count().collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted(tuple(r) for r in folds) == [(1, 60), (2, 60), (3, 60), (4, 60)]


@pytest.mark.parametrize("most", [200, 30, 3])
def test_wide_slices_are_cut_again(table, rows, most):
    ordered = sorted((t, i) for _, t, i in rows)
    ranks = [1, 2, 57, 200, 201, 399, 400]
    _, found = splits.keys_at_ranks(table, ["ts", "id"], lambda n: ranks, most)
    assert set(found) == set(ranks)
    for rank, key in found.items():
        assert tuple(table.select(key.alias("k")).first().k) == ordered[rank - 1]


def test_seeded_split_by_spark(spark):
    a, b = splits.random_split(spark.range(1000), [0.7, 0.3], 5)
    assert a.count() + b.count() == 1000 and 600 < a.count() < 800


def test_a_null_key_is_held_out_too(spark):
    rows = [(None, i) for i in range(6)] + [(1, i) for i in range(10, 13)]
    df = spark.createDataFrame(rows, "user int, id int")
    held = splits.leave_n_out(df, ["user"], ["id"], 1, 2).where("part = 'test'")
    assert sorted(r.id for r in held.collect()) == [0, 1, 10, 11]
    assert splits.leave_n_out(df, ["user"], ["id"], 1, 2).columns == ["user", "id", "part"]
