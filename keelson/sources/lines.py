"""Text lines: scans, sinks, and line formats that the csv reader cannot type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions import field, single_blanks, tokens_of


# Longest array Spark can hold: "to the end" for slices, without evaluating the array twice.
MAX_LENGTH = 2**31 - 1


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Watch a folder of text files; each new file joins the unbounded table of lines."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def write_lines(df: DataFrame, path: str) -> str:
    """Save a one-column string DataFrame as text."""
    df.write.mode("errorifexists").text(path)
    return path


def select_positional(
    lines: DataFrame, fields: Sequence[tuple[int, str, str]], sep: str = ",", value: str = "value"
) -> DataFrame:
    """Pick ``(index, type, name)`` fields of each line. A field that does not parse is NULL."""
    return lines.select(*(field(F.col(value), sep, i, kind).alias(name) for i, kind, name in fields))


def parse_adjacency(lines: DataFrame, value: str = "value", id_type: str = "bigint") -> DataFrame:
    """``id n1 n2 ...`` lines to ``(id, connections array)``; blank runs count as one separator.

    A vertex may own several lines, so ``id`` is not unique. Lines whose id does not parse are
    left out; a neighbour that does not parse is NULL.
    """
    text = single_blanks(F.col(value))
    # The id is cut off without the array: the filter on it is evaluated apart from the columns.
    first = F.substring_index(F.ltrim(text), " ", 1)
    rest = F.slice(tokens_of(F.col(value)), 2, MAX_LENGTH)
    return lines.select(
        first.try_cast(id_type).alias("id"), rest.try_cast(f"array<{id_type}>").alias("connections")
    ).where(F.col("id").isNotNull())
