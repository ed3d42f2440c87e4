"""Word counts over whole document texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions import words
from keelson.operators.keyed import word_counts as count_words
from keelson.operators.ranking import top_k
from keelson.plans.registry import query
from keelson.sources import table

COUNT_SQL = """
    SELECT word, count(*) AS n
    FROM (SELECT unnest(regexp_split_to_array(lower(text), '{pattern}')) AS word FROM documents)
    {where} GROUP BY word
"""
UNICODE = r"[^\p{L}\p{N}_]+"
ASCII = r"\W+"


def _texts(spark, folder):
    return table(spark, folder, "documents").select("text")


@query(COUNT_SQL.format(pattern=UNICODE, where="WHERE word <> ''"))
def word_counts(spark, folder):
    return count_words(_texts(spark, folder), "text")


@query(COUNT_SQL.format(pattern=ASCII, where="WHERE word <> ''"))
def word_counts_ascii(spark, folder):
    return count_words(_texts(spark, folder), "text", unicode=False)


@query(COUNT_SQL.format(pattern=ASCII, where=""))
def word_counts_with_empty(spark, folder):
    return count_words(_texts(spark, folder), "text", unicode=False, keep_empty=True)


@query(r"""
    SELECT word, count(*) AS n FROM
      (SELECT regexp_replace(word, '[^\x00-\x7F]', '', 'g') AS word FROM
         (SELECT unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+')) AS word FROM documents))
    WHERE word <> '' GROUP BY word
""")
def word_counts_stripped(spark, folder):
    return count_words(_texts(spark, folder), "text", ascii_only=True)


@query(f"""
    SELECT * FROM ({COUNT_SQL.format(pattern=UNICODE, where="WHERE word <> ''")})
    ORDER BY n DESC, word LIMIT 20
""")
def top_words(spark, folder):
    return top_k(count_words(_texts(spark, folder), "text"), ["-n", "word"], 20)


@query(f"""
    SELECT role, word, n FROM
      (SELECT role, word, count(*) AS n FROM
         (SELECT role, unnest(regexp_split_to_array(lower(text), '{UNICODE}')) AS word FROM conversations)
       WHERE word <> '' GROUP BY role, word)
""")
def word_counts_by_role(spark, folder):
    turns = table(spark, folder, "conversations")
    spoken = turns.select("role", F.explode(words(F.col("text"))).alias("word")).where("word <> ''")
    return spoken.groupBy("role", "word").agg(F.count(F.lit(1)).alias("n"))
