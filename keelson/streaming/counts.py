"""Counts that run unchanged on a batch table and on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.operators.ranking import top_k_per_group


def status_counts(logs: DataFrame, key: str = "status") -> DataFrame:
    """Running count per status; lines without one are counted under NULL."""
    return logs.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def window_counts(
    logs: DataFrame,
    key: str = "endpoint",
    time_col: str | None = None,
    size: str = "30 seconds",
    slide: str = "10 seconds",
    watermark: str | None = None,
) -> DataFrame:
    """Count per sliding window and key, as ``(window_start, window_end, key, n)``.

    ``time_col`` is an event-time timestamp; without one, rows are stamped with the processing
    time. A stream without ``watermark`` keeps every window in state; with one, closed windows
    are dropped from state and can be written in append mode.
    """
    if time_col is None:
        time_col = "event_time"
        logs = logs.withColumn(time_col, F.current_timestamp())
    if watermark:
        logs = logs.withWatermark(time_col, watermark)
    return (
        logs.groupBy(F.window(time_col, size, slide).alias("window"), F.col(key))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            key,
            "n",
        )
    )


def best_per_window(counts: DataFrame, key: str = "endpoint", k: int = 10) -> DataFrame:
    """The ``k`` largest counts of each window, ``rank`` from 1, ties to the smaller key.

    For the rows of ``window_counts``, as a batch or as what a trigger in append mode gives: the
    watermark closes all counts of a window in one trigger, so a window is always whole there.
    Every task trims its windows to ``k`` rows first.
    """
    return top_k_per_group(counts, ["window_start", "window_end"], ["-n", key], k)
