"""Recommendation and regression jobs on Spark ML."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from itertools import accumulate

from pyspark import StorageLevel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    LinearRegression,
    LinearRegressionModel,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Blocks of a side that an ALS fit has at least, if there are as many shuffle partitions, and the ratings
#: of a block beyond which it has more. Each factor is sent to each block of the other side that rated
#: it, in every half-iteration: blocks cost, but for memory and tasks they are not needed.
LEAST_BLOCKS, BLOCK_RATINGS = 12, 1 << 24


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` stored for the length of a fit, which reads it several times."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def numbered(ids: DataFrame, column: str, parts: int | None = None) -> DataFrame:
    """``(column, number)``: the different ids with dense ints from 0, for models that take ints only.

    Ids are dealt by a hash to so many parts and numbered in each; the parts' counts give the
    offsets, and are all that the driver sees.
    """
    parts = parts or int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ids.select(column).where(F.col(column).isNotNull()).distinct()
    dealt = dealt.withColumn("_part", F.pmod(F.xxhash64(column), F.lit(parts)).cast("int"))
    counts = {r["_part"]: r["n"] for r in dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if total > 2**31 - 1:
        raise ValueError(f"{total} different ids do not fit an int")
    before = dict(zip(sorted(counts), accumulate([0, *(counts[p] for p in sorted(counts))])))
    offset = F.element_at(F.create_map(*(F.lit(x) for pair in before.items() for x in pair)), F.col("_part")) if before else F.lit(0)
    place = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    return dealt.select(column, (offset + place - 1).cast("int").alias("number"))


def als_model(
    ratings: DataFrame,
    rank: int = 10,
    max_iter: int = 5,
    reg: float = 0.01,
    seed: int = 42,
    blocks: int | None = None,
) -> ALSModel:
    """Explicit-feedback ALS on ``(user, item, rating)``; ids must fit an int: see ``numbered``.

    ``blocks`` sets the user and item blocks, hence the tasks per half-iteration; by default as many
    as ``spark.sql.shuffle.partitions``, but no more than ``fit_blocks`` says.
    """
    with kept(ratings) as rows:
        blocks = blocks or fit_blocks(rows)
        return _als(rank, max_iter, reg, seed, blocks).fit(rows)


def fit_blocks(ratings: DataFrame) -> int:
    """Blocks for a fit: enough for all cores, and for ``BLOCK_RATINGS`` ratings in each."""
    spark = ratings.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = max(LEAST_BLOCKS, spark.sparkContext.defaultParallelism)
    return most if most <= needed else min(most, max(needed, -(-ratings.count() // BLOCK_RATINGS)))


def _als(rank: int, max_iter: int, reg: float, seed: int, blocks: int) -> ALS:
    return ALS(
        rank=rank,
        maxIter=max_iter,
        regParam=reg,
        seed=seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        userCol="user",
        itemCol="item",
        ratingCol="rating",
    )


def als_recommend(model: ALSModel, users: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best items for each given user, one row per ``(user, item, score, rank)``."""
    best = model.recommendForUserSubset(users.select("user"), k)
    return best.select("user", F.posexplode("recommendations").alias("pos", "best")).select(
        "user",
        F.col("best.item").alias("item"),
        F.col("best.rating").alias("score"),
        (F.col("pos") + 1).alias("rank"),
    )


def assemble(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``df`` plus ``features`` (vector) and ``label`` (double); rows with a NULL input are skipped."""
    vector = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    labelled = df.withColumn("label", F.col(label).cast("double")).where(F.col("label").isNotNull())
    return vector.transform(labelled)


def tree_regression(train: DataFrame, **params) -> DecisionTreeRegressionModel:
    # Not kept: the fit stores its own binned copy of the rows.
    return DecisionTreeRegressor(**params).fit(train)


def linear_regression(
    train: DataFrame, reg: float = 0.3, elastic_net: float = 0.8, max_iter: int = 10
) -> LinearRegressionModel:
    with kept(train) as rows:
        return LinearRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net).fit(rows)


def prediction_table(model, rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Model output beside the true value, from one row: ``(*keys, y_data, y_model)``."""
    return model.transform(rows).select(
        *keys, F.col("label").alias("y_data"), F.col("prediction").alias("y_model")
    )


def rmse(predictions: DataFrame, label: str = "y_data", prediction: str = "y_model") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse").evaluate(predictions)


def rmse_table(predictions: DataFrame, label: str = "y_data", prediction: str = "y_model") -> DataFrame:
    """``rmse`` as a one-row DataFrame ``(n, rmse)``."""
    error = F.col(prediction) - F.col(label)
    return predictions.agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(error * error)).alias("rmse")
    )
