"""Benchmark items inside documents: MinHash containment search over partitions by item size.

An item with ``m`` different shingles is contained if a document holds ``t m`` of them. The item's
sketch is its ``k`` smallest shingle hashes. Of any ``m - ceil(t m) + 1`` shingles of a contained
item the document must hold one, so a sketch of that size cannot miss. Items are partitioned by the
power of two below ``m``, and a partition's upper bound fixes ``k`` for all its items. Documents
that hold a value of a sketch are candidates; the exact share of the item's shingles decides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import KEY, keyed, stored


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _ahead(words: Column, by: int) -> Column:
    return F.slice(words, by + 1, F.size(words)) if by else words


def _starts(shingles: Column, words: Column, length: int) -> Column:
    """The leading entries, without those that run over the end of the text."""
    return F.when(F.size(words) >= length, F.slice(shingles, 1, F.greatest(F.size(words) - length + 1, F.lit(0))))


def _hashed(words: Column, length: int) -> Column:
    """A hash for every shingle of hashed words, null if they are too few.

    Words are zipped with the words after them, so that no lambda refers to the whole array: were the
    array computed anew inside one, the work would grow with the square of a text's length.
    """
    runs = F.arrays_zip(*(_ahead(words, i) for i in range(length)))
    return _starts(F.transform(runs, lambda x: F.xxhash64(x)), words, length)


def _joined(words: Column, length: int) -> Column:
    """The shingles themselves, words joined by blanks."""
    out = words
    for i in range(1, length):
        out = F.zip_with(out, _ahead(words, i), lambda a, b: F.concat_ws(" ", a, b))
    return _starts(out, words, length)


def _whole(make, words: Column, length: int) -> Column:
    """An item's shingles; one with fewer words than a shingle is its only one."""
    out = make(words, length)
    for short in range(1, length):
        out = F.when(F.size(words) == short, make(words, short)).otherwise(out)
    return out


def _word_hashes(rows: DataFrame) -> DataFrame:
    """``rows (..., text)`` with ``w``, a hash of every word, in place of the text."""
    return rows.withColumn("w", F.transform(words_of(F.col("text")), lambda x: F.xxhash64(x))).drop("text")


def sketches(items: DataFrame, threshold: float = 0.8, length: int = 5) -> DataFrame:
    """``item_id, text_hash, words, part, m, hash`` for each sketch value of ``items (item_id, text)``.

    ``words`` is the length of the item's shingles.
    """
    rows = items.select("item_id", "text", F.xxhash64("text").alias("text_hash")).distinct()
    each = _word_hashes(rows).select(
        "item_id", "text_hash", F.least(F.size("w"), F.lit(length)).alias("words"),
        F.explode_outer(F.array_distinct(_whole(_hashed, F.col("w"), length))).alias("hash"),
    ).where("hash IS NOT NULL")
    own = Window.partitionBy("item_id", "text_hash")
    ranked = each.withColumns(
        {"m": F.count("*").over(own), "rank": F.row_number().over(own.orderBy("hash"))}
    )
    part = F.floor(F.log2("m")).cast("int")
    bound = F.pow(F.lit(2), part + 1) - 1
    size = bound - F.ceil(bound * threshold) + 1
    return ranked.withColumn("part", part).where(F.col("rank") <= size).drop("rank")


def contained(docs: DataFrame, items: DataFrame, threshold: float = 0.8, length: int = 5) -> DataFrame:
    """``_null, _id, _hash, item_id, item_shingles, found, containment`` for each item inside a document.

    Words are runs of letters and digits in lower case. An item with fewer than ``length`` words is
    its own only shingle, and is looked for among runs of that many words. Texts and items without a
    word take no part, nor do null ones; very long texts are read whole. Items that share an id count
    each for itself, and the best match is reported; a null id is a value. Repeated rows count once.
    Other columns are not looked at, and an empty table of either kind gives an empty result.
    """
    rows = keyed(docs.select("doc_id", "text")).where("row.text IS NOT NULL").select(*KEY, "row.text")
    sketch = stored(sketches(items, threshold, length), "item-sketches")
    # At most as many lengths as a shingle has words; without short items it is one.
    lengths = sorted(r["words"] for r in sketch.select("words").distinct().collect()) or [length]
    hashed = _word_hashes(rows)
    probes = reduce(DataFrame.unionByName, (
        hashed.select(*KEY, _hashed(F.col("w"), n).alias("hashes"), F.lit(n).alias("words")) for n in lengths
    )).select(*KEY, "words", F.coalesce(F.size("hashes"), F.lit(0)).alias("n"), F.explode_outer("hashes").alias("hash"))
    fit = (probes.hash == sketch.hash) & (probes.words == sketch.words) & (probes.n >= F.ceil(sketch.m * threshold))
    pairs = stored(probes.join(sketch, fit).select(*KEY, "item_id", "text_hash").distinct(), "item-candidates")

    # The exact check reads the candidates' texts again and compares the shingles themselves.
    named = items.select("item_id", "text", F.xxhash64("text").alias("text_hash")).distinct()
    lists = named.select("item_id", "text_hash", words_of(F.col("text")).alias("w"))
    lists = lists.select("item_id", "text_hash", F.array_distinct(_whole(_joined, F.col("w"), length)).alias("shingles"))
    targets = lists.select(
        "item_id", "text_hash", F.coalesce(F.size("shingles"), F.lit(0)).alias("m"), F.explode_outer("shingles").alias("shingle")
    )
    marked = pairs.select(*KEY).distinct()
    held = rows.join(marked, list(KEY), "left_semi").select(*KEY, words_of(F.col("text")).alias("w"))
    # Shingles of different lengths are never equal: blanks divide their words.
    held = reduce(DataFrame.unionByName, (
        held.select(*KEY, F.explode_outer(_joined(F.col("w"), n)).alias("shingle")) for n in lengths
    ))
    hits = held.join(targets, "shingle")
    wanted = [hits[c] == pairs[c] for c in (*KEY, "text_hash")] + [hits.item_id.eqNullSafe(pairs.item_id)]
    hits = hits.distinct().join(pairs, wanted, "left_semi")
    counted = hits.groupBy(*KEY, "item_id", "text_hash").agg(F.first("m").alias("m"), F.count("*").alias("found"))
    passed = counted.where(F.col("found") >= F.col("m") * threshold)
    best = F.max(F.struct((F.col("found") / F.col("m")).alias("c"), "found", F.col("m").cast("bigint").alias("m")))
    return passed.groupBy(*KEY, "item_id").agg(best.alias("b")).select(
        *KEY, "item_id", F.col("b.m").alias("item_shingles"), F.col("b.found").alias("found"),
        F.col("b.c").alias("containment"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.8, length: int = 5) -> DataFrame:
    """The rows of ``docs`` that hold no item. Columns are those of ``docs``."""
    found = stored(contained(docs, items, threshold, length).select(*KEY).distinct(), "contaminated")
    return keyed(docs).join(found, list(KEY), "left_anti").select("row.*")
