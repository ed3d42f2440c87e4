"""A cleaning pipeline over ``documents``: five stages, each stored as Parquet before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import contamination, lines, packing, simhash, toxicity
from keelson.llm.common import held_out, keyed
from keelson.session import Held, working
from keelson.sources import table


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go. It learns from the labels of four ids in five.

    A null text is judged as an empty one, a very long one whole. Repeated rows share a judgement.
    Without labels nothing is toxic. An empty table gives an empty one.
    """
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~held_out(5, 0)))
    judged = toxicity.with_score(keyed(docs), model, "row.text")
    return judged.where("score < 0.5").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines are cut out of all but their first place; ``n_chars`` follows.

    Every row stays: a null text null, and one all of whose lines go as an empty text. A wholly
    repeated row is cut like the first. Very long texts are taken whole; empty tables stay empty.
    """
    found = lines.dedup_lines(docs)
    size = F.coalesce(F.length("row.text"), F.lit(0)).cast("bigint")
    same = F.col("n_removed") == 0
    return found.withColumn(
        "row", F.when(same, F.col("row")).otherwise(F.col("row").withField("n_chars", size))
    ).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates one document stays.

    Null, empty and wordless texts are one group, as their fingerprint is zero. Of wholly repeated
    rows one stays. Very long texts are taken whole; an empty table gives an empty one.
    """
    return simhash.keep_one(docs, length=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and wordless texts hold none and stay, and so do all without a benchmark. Repeated rows
    share the decision. Very long texts are searched whole; an empty table gives an empty one.
    """
    return contamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left becomes pieces of sequences of at most 1024 tokens, each with its token ids.

    A null or empty text is its end token alone. Repeated rows are packed each, very long texts cut
    into pieces; an empty table gives an empty one.
    """
    return packing.pack(docs, capacity=1024, ids=True)


STAGES = [
    ("toxicity", clean),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", windows),
]

#: SQL cannot say the learned first stage or the tokens of the last; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's inner tables and its input go once its output is stored, so
    that what stays on disk is the result alone."""
    docs, held = table(spark, sf_dir, "documents"), Held(spark, "pipeline")
    for name, stage in STAGES:
        with working(spark, name):
            docs = held.put(stage(spark, docs, sf_dir))
    return docs
