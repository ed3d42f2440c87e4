"""Delimited text, typed on read.

Paths are Hadoop URIs, so object stores need no code of their own. A schema narrower than the
file drops the trailing columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    sep: str = ",",
    header: bool = False,
    encoding: str = "UTF-8",
) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("encoding", encoding)
        # A narrow schema is a wanted projection, not a header mismatch.
        .option("enforceSchema", True)
        .csv(path)
    )


def read_inferred(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Header plus inferred types. Inference reads the whole input once more: give a schema at scale."""
    return (
        spark.read.option("sep", sep)
        .option("header", True)
        .option("inferSchema", True)
        .option("encoding", encoding)
        .csv(path)
    )


def write_delimited(
    df: DataFrame, path: str, sep: str = ",", header: bool = False, encoding: str = "UTF-8"
) -> str:
    (
        df.write.mode("errorifexists")
        .option("sep", sep)
        .option("header", header)
        .option("encoding", encoding)
        .csv(path)
    )
    return path
