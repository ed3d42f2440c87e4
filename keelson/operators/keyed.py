"""Keyed and global aggregation.

Each operator is one ``groupBy().agg()``: Catalyst combines on the map side, so a key that holds
a third of all rows sends one partial row per task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from keelson.functions import to_ascii, words


def histogram(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    """Rows per distinct value, sorted by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(count)).orderBy(column)


def exact_mean(total: Column, n: Column, scale: int, places: int) -> Column:
    """``total / n`` of decimals with ``scale`` digits, rounded half up once, by whole numbers alone.

    A quotient that is cut to some digits first, or kept in binary, can fall on the wrong side of a
    half. NULL where ``n`` is 0.
    """
    whole = "decimal(38,0)"
    ups = (F.abs(total) * 10**scale).cast(whole) * F.lit(10 ** max(places - scale, 0)).cast("decimal(18,0)")
    downs = n.cast("decimal(19,0)") * F.lit(10 ** max(scale - places, 0)).cast("decimal(18,0)")
    half_up = F.call_function("div", ups.cast(whole) * 2 + downs, downs.cast(whole) * 2)
    unit = F.lit(Decimal(1).scaleb(-places))
    return F.when(n > 0, (F.signum(total).cast("int") * half_up).cast("decimal(20,0)") * unit)


def mean_by(
    df: DataFrame, keys: Sequence[str], column: str, places: int | None = None, alias: str = "mean"
) -> DataFrame:
    """Mean per key. A rounded mean of decimals is exact; of doubles it depends on the rows' order."""
    kind = df.schema[column].dataType
    if places is not None and isinstance(kind, DecimalType):
        mean = exact_mean(F.sum(column), F.count(column), kind.scale, places)
        return df.groupBy(*keys).agg(mean.alias(alias))
    mean = F.avg(column)
    return df.groupBy(*keys).agg((mean if places is None else F.round(mean, places)).alias(alias))


def mean_all(df: DataFrame, keys: Sequence[str], places: int | None = None) -> DataFrame:
    """Mean of every numeric column per key, the numeric keys included, as ``avg_<column>``."""
    numeric = [f.name for f in df.schema if f.dataType.typeName() in NUMERIC]
    means = {c: F.avg(c) for c in numeric}
    return df.groupBy(*keys).agg(
        *((m if places is None else F.round(m, places)).alias(f"avg_{c}") for c, m in means.items())
    )


# Spark's numeric type names.
NUMERIC = {"byte", "short", "integer", "long", "float", "double", "decimal"}


def sum_by(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    places: int | None = 2,
    ascending: bool | None = True,
    alias: str = "total",
) -> DataFrame:
    """Total per key, sorted by total and then key; ``ascending=None`` leaves it unsorted."""
    total = F.sum(column)
    out = df.groupBy(*keys).agg((total if places is None else F.round(total, places)).alias(alias))
    if ascending is None:
        return out
    return out.orderBy(F.col(alias).asc() if ascending else F.col(alias).desc(), *keys)


def extreme_by(df: DataFrame, keys: Sequence[str], column: str, how: str, alias: str | None = None) -> DataFrame:
    """Smallest (``how="min"``) or largest (``how="max"``) value per key."""
    pick = {"min": F.min, "max": F.max}[how]
    return df.groupBy(*keys).agg(pick(column).alias(alias or f"{how}_{column}"))


def global_agg(df: DataFrame, column: str) -> DataFrame:
    """One row: least and greatest value of a column, and the number of rows."""
    return df.agg(
        F.min(column).alias(f"min_{column}"),
        F.max(column).alias(f"max_{column}"),
        F.count(F.lit(1)).alias("n"),
    )


def word_counts(
    df: DataFrame,
    column: str,
    unicode: bool = True,
    keep_empty: bool = False,
    ascii_only: bool = False,
) -> DataFrame:
    """Count of each lower-case word. ``ascii_only`` also strips other characters from the words."""
    word = F.explode(words(F.col(column), unicode)).alias("word")
    out = df.select(word)
    if ascii_only:
        out = out.select(to_ascii(F.col("word")).alias("word"))
    if not keep_empty:
        out = out.where(F.col("word") != "")
    return out.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
