import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import models


def test_tree_finds_a_step(spark):
    df = spark.range(400).select((F.col("id") % 20).alias("x"), F.when(F.col("id") % 20 < 8, 1.0).otherwise(5.0).alias("y"))
    rows = models.assemble(df, ["x"], "y")
    table = models.prediction_table(models.tree_regression(rows), rows, ["x"])
    assert all(r.y_model == r.y_data for r in table.collect())
    assert models.rmse(table) == 0.0
    assert tuple(models.rmse_table(table).first()) == (400, 0.0)


def test_line_equals_the_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=300)
    y = -x + 0.1 * rng.normal(size=300)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    model = models.linear_regression(models.assemble(df, ["x"], "y"))
    rho, sx, sy = np.corrcoef(x, y)[0, 1], x.std(), y.std()
    slope = np.sign(rho) * max(abs(rho) - 0.24 / sy, 0) / (1 + 0.06 / sy) * sy / sx
    assert model.coefficients[0] == pytest.approx(slope, abs=1e-4)
    assert model.intercept == pytest.approx(y.mean() - slope * x.mean(), abs=1e-4)


def test_rmse_agrees_with_the_evaluator(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.5), (0.0, -1.0)], "y_data double, y_model double")
    assert models.rmse_table(df).first().rmse == pytest.approx(models.rmse(df))


def test_rows_with_a_missing_value_are_skipped(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (1.0, None)], "x double, y double")
    assert models.assemble(df, ["x"], "y").count() == 1


def test_recommendations(spark):
    # Two tastes: even users like even items.
    rows = [(u, i, 5.0 if (u + i) % 2 == 0 else 1.0) for u in range(20) for i in range(20) if (u * 7 + i) % 5]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double")
    model = models.als_model(ratings, blocks=2)
    users = spark.createDataFrame([(0,), (1,)], "user int")
    got = models.als_recommend(model, users, k=5).collect()
    for user in (0, 1):
        mine = sorted((r["rank"], r.item, r.score) for r in got if r.user == user)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert all(m[1] % 2 == user for m in mine)
        assert [m[2] for m in mine] == sorted((m[2] for m in mine), reverse=True)


def test_dense_numbers_for_any_ids(spark):
    ids = [2**40 + i * i for i in range(300)]
    df = spark.createDataFrame([(i,) for i in [*ids, *ids[:50], None]], "user bigint")
    for parts in (1, 7):
        found = {r.user: r.number for r in models.numbered(df, "user", parts).collect()}
        assert set(found) == set(ids) and sorted(found.values()) == list(range(300))
    assert models.numbered(df.limit(0), "user").count() == 0


def test_blocks_do_not_grow_with_partitions(spark, monkeypatch):
    """Every factor is sent to each block that needs it, so that blocks are what a fit shuffles."""
    ratings = spark.createDataFrame([(u, i, 1.0) for u in range(10) for i in range(10)], "user int, item int, rating double")
    cores = max(models.LEAST_BLOCKS, spark.sparkContext.defaultParallelism)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, rows, want in ((5, 10, 5), (900, 100, cores), (900, 1, 100), (50, 1, max(cores, 50))):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            monkeypatch.setattr(models, "BLOCK_RATINGS", rows)
            assert models.fit_blocks(ratings) == min(want, partitions)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
