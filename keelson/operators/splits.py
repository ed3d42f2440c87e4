"""Reproducible data splits: held-out ranks per key, positional folds, hash split.

Rows have no file order in Spark, so the positional splits take an explicit ``order``: ascending,
not NULL, unique (per key for ``leave_n_out`` without a cap). Neither numbers all rows in one
task: both find the few order keys where a part ends and then label every row by comparison.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Sequence
from functools import reduce
from itertools import accumulate
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions import row_struct
from keelson.operators.ranking import top_k_per_group


def keys_at_ranks(
    df: DataFrame, order: Sequence[str], ranks: Callable[[int], Sequence[int]], most: int = 1_000_000
) -> tuple[int, dict[int, Column]]:
    """The number of rows ``n``, and the order key at each 1-based rank of ``ranks(n)``.

    Keys are literal structs, comparable with ``row_struct(order)``; ranks outside ``1..n`` are
    left out. A range shuffle of the order columns gives the row count and key range of every
    slice (one driver row per slice). Slices that hold a wanted rank and more than ``most`` rows
    are cut by range again, so that no task sorts more than that; then those left are sorted.
    """
    keys = df.select(*order)
    row = row_struct(order)
    types = {c: keys.schema[c].dataType for c in order}
    # A clock time in a zone is ambiguous in the hour that a clock change repeats: micros are not.
    pieces = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    zoned = {c for c in order if types[c].typeName() == "timestamp"}

    def text(c: str, at: str = "") -> Column:
        value = F.col(f"{at}{c}")
        return (F.unix_micros(value) if c in zoned else value).cast("string")

    def value(c: str, said: str) -> Column:
        return F.timestamp_micros(F.lit(int(said))) if c in zoned else F.lit(said).cast(types[c])

    def literal(values: Sequence[str]) -> Column:
        return F.struct(*(value(c, v).alias(c) for c, v in zip(order, values)))

    def measured(rows: DataFrame, *parts: str) -> list:
        return (
            # With a number given, AQE does not merge the slices again.
            rows.repartitionByRange(pieces, *parts, *order)
            .groupBy(F.spark_partition_id().alias("slice"), *parts)
            .agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("lo"), F.max(row).alias("hi"))
            .orderBy("lo")
            .select("n", *(text(c, f"{s}.").alias(f"{s}_{c}") for s in ("lo", "hi") for c in order))
            .collect()
        )

    def inside(slices: list) -> Column:
        """The number of the slice that holds a row, of some that do not overlap."""
        tag = F.when(F.lit(False), F.lit(0))
        for i, s in enumerate(slices):
            first, lo, hi = order[0], *([s[f"{side}_{c}"] for c in order] for side in ("lo", "hi"))
            # The leading column alone can prune row groups; the whole key decides.
            lead = F.col(first).between(value(first, lo[0]), value(first, hi[0]))
            tag = tag.when(lead & row.between(literal(lo), literal(hi)), F.lit(i))
        return tag

    def holding(slices: list, before: int, wanted: Sequence[int]) -> list:
        """``(slice, rows before it, its ranks)`` of the slices that hold a wanted rank."""
        ends = [before + end for end in accumulate(s["n"] for s in slices)]
        held: dict[int, list[int]] = {}
        for rank in wanted:
            held.setdefault(bisect_left(ends, rank), []).append(rank)
        return [(slices[i], ends[i] - slices[i]["n"], found) for i, found in held.items()]

    slices = measured(keys)
    n = sum(s["n"] for s in slices)
    todo = holding(slices, 0, sorted({r for r in ranks(n) if 1 <= r <= n}))
    if not todo:
        return n, {}
    whole: set[int] = set()  # slices that a cut left whole, by the rows before them
    while wide := [t for t in todo if t[0]["n"] > most and t[1] not in whole]:
        parts = measured(keys.withColumn("slice", inside([t[0] for t in wide])).where("slice IS NOT NULL"), "slice")
        todo = [t for t in todo if t not in wide]
        at = iter(parts)  # in order of their keys, as ``wide`` is
        for s, before, wanted in wide:
            own, rows = [], 0
            while rows < s["n"]:
                own.append(next(at))
                rows += own[-1]["n"]
            if len(own) == 1:
                whole.add(before)
            todo += holding(own, before, wanted)
        todo.sort(key=lambda t: t[1])
    places = [f"{i}:{rank - before}" for i, (_, before, wanted) in enumerate(todo) for rank in wanted]
    found = (
        keys.withColumn("slice", inside([t[0] for t in todo]))
        .where(F.col("slice").isNotNull())
        .withColumn("local", F.row_number().over(Window.partitionBy("slice").orderBy(*order)))
        .where(F.concat_ws(":", "slice", "local").isin(places))
        .select("slice", "local", *(text(c).alias(f"key_{c}") for c in order))
        .collect()
    )
    return n, {todo[f["slice"]][1] + f["local"]: literal([f[f"key_{c}"] for c in order]) for f in found}


def k_fold(df: DataFrame, order: Sequence[str], k: int, fold: str = "fold") -> DataFrame:
    """Label each row with its fold 1..k: fold ``i`` holds ranks ``(i-1)*n/k+1 .. i*n/k`` of ``order``.

    The test part of fold ``i`` is ``fold = i``, its base part all other rows. Labelling is a
    comparison with ``k-1`` literals: no shuffle of the rows themselves.
    """
    n, last = keys_at_ranks(df, order, lambda n: [i * n // k for i in range(1, k)])
    row = row_struct(order)
    # With fewer rows than folds an early fold may be empty: every row is past its end.
    past = [(row > last[end]).cast("int") if end else F.lit(1) for end in (i * n // k for i in range(1, k))]
    return df.withColumn(fold, _total([F.lit(1), *past]).cast("int"))


def leave_n_out(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    start: int,
    stop: int,
    max_test: int | None = None,
    part: str = "part",
) -> DataFrame:
    """Label rows ranked ``start..stop`` within their key ``'test'``, all others ``'base'``.

    ``max_test`` keeps only the first so many test rows of the whole ``order``; ``order`` must
    then be unique over all rows. Only ranks up to ``stop`` are sorted per key, after each task
    has trimmed its groups; the rows are then labelled by the key range of their test rows.
    """
    held = top_k_per_group(df.select(*keys, *order), keys, order, stop).where(F.col("rank") >= start)
    row = row_struct(order)
    if max_test and max_test > 0:
        _, cut = keys_at_ranks(held, order, lambda n: [max_test])
        if cut:
            held = held.where(row <= cut[max_test])
    names = [f"_key{i}" for i in range(len(keys))]
    bounds = held.groupBy(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True))).agg(
        F.min(row).alias("_first"), F.max(row).alias("_last")
    )
    is_test = row.between(F.col("_first"), F.col("_last"))
    # A null key is a key.
    same = reduce(and_, (df[k].eqNullSafe(bounds[n]) for k, n in zip(keys, names, strict=True)))
    return (
        df.join(bounds, same, "left")
        .withColumn(part, F.when(is_test, "test").otherwise("base"))
        .drop("_first", "_last", *names)
    )


def hash_split(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int = 0, part: str = "part"
) -> DataFrame:
    """Label rows 0, 1, .. in proportion to ``weights`` by a hash of their keys.

    The same key and seed give the same part whatever the partitioning, in any engine with md5:
    the first 8 hex digits of ``md5("key1:key2:..:seed")`` are compared with the cut points.
    """
    text = F.concat_ws(":", *(F.col(c).cast("string") for c in keys), F.lit(str(seed)))
    digits = F.substring(F.md5(text), 1, 8)
    passed = [(digits >= cut).cast("int") for cut in hash_cuts(weights)]
    return df.withColumn(part, _total([F.lit(0), *passed]).cast("int"))


def _total(columns: list[Column]) -> Column:
    """Sum of many columns as a balanced tree: a chain would be as deep as it is long."""
    while len(columns) > 1:
        columns = [reduce(add, columns[i: i + 2]) for i in range(0, len(columns), 2)]
    return columns[0]


def hash_cuts(weights: Sequence[float]) -> list[str]:
    """Ends of all parts but the last, as 8 hex digits. A part of weight 0 stays empty."""
    if not weights or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError(f"weights must not be negative, and not all 0: {list(weights)}")
    shares = list(accumulate(weights))
    return [_hex(round(s / shares[-1] * 2**32)) for s in shares[:-1]]


def _hex(cut: int) -> str:
    """8 hex digits, and for the end of the range a text that sorts after all of them."""
    return f"{cut:08x}" if cut < 2**32 else "g"


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 0) -> list[DataFrame]:
    """Spark's seeded split. The parts hold for one layout of the rows; ``hash_split`` for any."""
    return df.randomSplit(list(weights), seed)
