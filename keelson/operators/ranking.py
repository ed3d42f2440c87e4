"""Top-k, ties, top-k per group, and name lookup.

An order is a list of column names, ``-name`` meaning descending, and should end in a unique key:
then the same rows win whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions import sort_keys


def top_k(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """First ``k`` rows: each task keeps ``k``, no global sort (TakeOrderedAndProject)."""
    return df.orderBy(*sort_keys(order)).limit(k)


def bottom_ties(df: DataFrame, column: str) -> DataFrame:
    """Every row that equals the least value. The minimum is a scalar subquery, not a driver round trip."""
    return df.where(F.col(column) == df.agg(F.min(column)).scalar())


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows of each group, numbered from 1.

    Up to Spark's window-group-limit threshold every task trims each group to ``k`` rows before
    the shuffle, so a hot group stays small. Larger ``k`` would skip that, so groups are first
    trimmed in salted parts.
    """
    sort = sort_keys(order)
    number = F.row_number()
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        salt = F.pmod(F.xxhash64(*(F.col(c.lstrip("-")) for c in order)), F.lit(parts))
        salted = Window.partitionBy(*keys, "_salt").orderBy(*sort)
        df = df.withColumn("_salt", salt).withColumn("_part_rank", number.over(salted))
        df = df.where(F.col("_part_rank") <= k).drop("_salt", "_part_rank")
    whole = Window.partitionBy(*keys).orderBy(*sort)
    return df.withColumn(rank, number.over(whole)).where(F.col(rank) <= k)


def attach_name(df: DataFrame, names: DataFrame, key: str, few: int | None = None) -> DataFrame:
    """Left join of ``names`` on ``key``; a row without a name keeps NULL.

    The join strategy is left to the optimizer, which broadcasts ``names`` only below its size
    threshold. ``few`` makes ``df`` a short report of so many rows at most: its keys then filter
    the name table while it is scanned, so that a large one is not shuffled.
    """
    if few is not None:
        df = df.limit(few)
        names = names.join(F.broadcast(df.select(key)), key, "left_semi")
    return df.join(names, key, "left")
