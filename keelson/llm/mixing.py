"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis-Spirakis).

Every document draws an exponential variable from a hash of its id and divides it by its quality
weight; in the order of these keys, the first documents of a source are a weighted sample of it.
A source's target is met by complete epochs first, then by documents in that order until the words
before them fill what is left. The last one gives its first words only, so targets are met exactly.

Word counts before a document are sums along an order. One source may hold a third of all rows, so
no source is sorted in one task: the order is cut into ranges, sums run inside each range, and the
ranges' totals are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import KEY, keyed, stored
from keelson.operators.positions import running

#: A word: blanks and the ASCII line and page breaks divide.
WORD = r"[^\x20\x09-\x0D]+"
#: A source as two columns that are never null and sort as the source does, null last.
SOURCE = ("_none", "_source")


def targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``_none, _source, source_size, target`` for ``sizes (_none, _source, size)``.

    The n-th source by code point weighs the n-th of ``weights``, which repeat. Sources whose share
    would pass ``most`` times their size get that, and the rest is shared anew, until none passes.
    """
    each = sizes.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"))
    ranked = running(each, (), SOURCE, F.lit(1), "nth")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights) + 1).cast("int"))
    ranked = stored(ranked.withColumn("weight", weight.cast("bigint")).drop("nth"), "sources")
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    total, heavy = ranked.agg(F.sum(wide("source_size")), F.sum("weight")).first()
    total, heavy = int(total or 0), int(heavy or 0)
    left, open_weight, capped = total, heavy, -1
    full = F.lit(False)
    while open_weight:
        # A share is left * weight / open_weight; compared without dividing.
        full = wide("source_size") * most * open_weight <= wide("weight") * F.lit(left).cast("decimal(38,0)")
        n, taken, weighs = ranked.where(full).agg(
            F.count("*"), F.sum(wide("source_size") * most), F.sum("weight")
        ).first()
        if n == capped:
            break
        capped, left, open_weight = n, total - int(taken or 0), heavy - int(weighs or 0)
    share = F.col("weight").cast("double") * float(left) / float(open_weight or 1)
    cap = (F.col("source_size") * most).cast("double")
    return ranked.select(*SOURCE, "source_size", F.when(full, cap).otherwise(share).alias("target"))


def draw(row_id: Column, text: Column, weight: Column, seed: str) -> Column:
    """An exponential variable over ``weight``; a null id draws by its text, no weight comes last."""
    name = F.coalesce(row_id.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary")), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("bigint") + 0.5) / float(1 << 52)
    return F.when(weight > 0, -F.log(uniform) / weight).otherwise(float("inf"))


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """``_null, _id, _hash, source, size, source_size, target, taken`` for each row of ``docs``.

    ``quality (doc_id, weight)`` weighs documents; one without a row weighs 1, of several rows the
    largest counts, and weights of 0 or less come last. ``size`` counts words, 0 for a null or empty
    text. ``taken`` is the words that the mix takes of a document, repeats counted, at most ``most``
    times its size; over a source they sum up to its target, rounded. A null source is one of its
    own, and so is an empty one. Repeated rows each count; rows with one id and different texts draw
    alike and are taken in order of a hash. Only ``doc_id, text, source`` are looked at, and an
    empty table gives an empty one. Runs agree whatever the partitioning.
    """
    rows = keyed(docs.select("doc_id", "text", "source"))
    measured = rows.select(
        *KEY,
        F.col("row.source").isNull().alias(SOURCE[0]),
        F.coalesce("row.source", F.lit("")).alias(SOURCE[1]),
        F.coalesce(F.regexp_count("row.text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        draw(F.col("row.doc_id"), F.col("row.text"), F.lit(1.0), seed).alias("draw"),
    )
    sized = stored(measured, "sizes")
    shares = stored(targets(sized, weights, most), "targets")
    if quality is not None:
        weighed = quality.groupBy(
            F.col("doc_id").isNull().alias(KEY[0]), F.coalesce("doc_id", F.lit(0)).alias(KEY[1])
        ).agg(F.max("weight").cast("double").alias("weight"))
        own = F.coalesce("weight", F.lit(1.0))
        sized = sized.join(weighed, [KEY[0], KEY[1]], "left").withColumn(
            "draw", F.when(own > 0, F.col("draw") / own).otherwise(float("inf"))
        ).drop("weight")
    placed = running(sized, SOURCE, ("draw", *KEY), F.col("size"), "before")
    joined = placed.join(shares, list(SOURCE))
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5) div source_size")).otherwise(0)
    rest = budget - epochs * F.col("source_size") - F.col("before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least("size", rest))
    return joined.select(
        *KEY, F.when(~F.col(SOURCE[0]), F.col(SOURCE[1])).alias("source"), "size", "source_size", "target",
        taken.cast("bigint").alias("taken"),
    )


def drawn(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``row`` and ``epoch`` (from 1): the documents that ``mix`` takes, once for each time.

    A document taken in part gives its first words, joined by blanks. Copies of a wholly repeated
    row are one document that is taken as often as all of them.
    """
    plan = mixed.groupBy(*KEY).agg(F.sum("taken").alias("taken"), F.first("size").alias("size")).where("taken > 0")
    times = F.sequence(F.lit(1), F.expr("(taken + size - 1) div size"))
    each = keyed(docs).dropDuplicates(list(KEY)).join(plan, list(KEY)).withColumn("epoch", F.explode(times))
    part = F.col("taken") - (F.col("epoch") - 1) * F.col("size")
    words = F.slice(F.regexp_extract_all("row.text", F.lit(WORD), F.lit(0)), F.lit(1), part.cast("int"))
    text = F.when(part >= F.col("size"), F.col("row.text")).otherwise(F.array_join(words, " "))
    return each.select(F.col("row").withField("text", text).alias("row"), F.col("epoch").cast("int").alias("epoch"))
