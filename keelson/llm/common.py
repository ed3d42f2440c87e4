"""What several operators share: row keys, stored tables, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.session import Held, work_dir, working

#: The row key that ``keyed`` makes. None of the three is ever null, and they sort null ids last.
KEY = ("_null", "_id", "_hash")


def held_out(modulus: int, remainder: int, id_col: str = "doc_id") -> Column:
    """Whether the CRC-32 of the id as text leaves ``remainder``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once to the shared working folder and read from there.

    Cuts the lineage: a lost executor costs the reading of a file and not the work before it.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` with all columns of ``docs``, and ``_null, _id, _hash``, which name it by id and text.

    Rows that repeat an id with another text stay apart; wholly repeated rows share a key and so
    share every decision. A null id is a value like any other. The caller's columns are inside
    ``row``, so that none of their names can clash; ``select("row.*")`` brings them back.
    """
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(id_col).isNull().alias(KEY[0]),
        F.coalesce(F.col(id_col), F.lit(0)).alias(KEY[1]),
        F.xxhash64(F.col(text), F.col(text).isNull()).alias(KEY[2]),
    )


def key_id(prefix: str = "") -> Column:
    """The document id that a key stands for."""
    return F.when(~F.col(f"{prefix}{KEY[0]}"), F.col(f"{prefix}{KEY[1]}"))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
    ).first()
    return row["n"], int(row["s"] or 0)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges (u, v)``, root the smallest node.

    Alternates two steps until nothing changes: every node points its larger neighbours, then all
    its smaller ones, at the smallest node it knows. The number of rounds grows with the logarithm
    of the longest path. Minima are combined on the map side, stored and joined back, so that a
    node with a third of the edges is split like any skewed join. Each round is stored, and the tables of
    the round before are removed: what is on disk does not grow with the rounds.
    """
    spark = edges.sparkSession
    held = Held(spark, label)
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = held.put(edges.distinct())
    before = _state(edges)
    while before[0]:
        with working(spark, label):
            both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
            large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            large = stored(large.where("u != v").distinct(), "large")
            low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "low")
            small = large.join(low, "u")
            small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").union(
                low.select("u", F.col("m").alias("v"))
            )
            edges = held.put(small.distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
