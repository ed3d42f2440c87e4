"""Repeated runs of lines, found by winnowing and deleted where they occur again.

The window of a line holds it and all lines that start within the next ``min_chars`` characters;
a window that the text's end cuts short does not count. The line with the smallest hash in a window
is its fingerprint. Equal windows have equal fingerprints, so a repeated run of ``min_chars``
characters or more always shows a repeated fingerprint. Only positions with such fingerprints are
compared further. A window whose lines occurred before is joined to their first occurrence, and the
match is extended line by line to both sides while lines are equal, up to the texts' ends; the whole
later run is deleted.

Most of that costs no further pass. Before a matched window every equal line starts a window that
lies in the match, and so is matched itself. Behind the last equal window of a match the equal lines
all start within ``min_chars`` characters of the next line: each position brings their hashes along.
Only where the next window first occurred elsewhere has the match to be followed, by joins of blocks
of lines that double their reach, until it ends or a window is joined to the same text again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import KEY, keyed, stored
from keelson.session import Held, working

#: Lines of a block: what a match is followed by at a time.
BLOCK = 64


def windows(rows: DataFrame, min_chars: int) -> DataFrame:
    """Per line that starts a whole window: ``_id, _hash, line, last, mark, mark_line, run, next``.

    ``mark`` is the fingerprint, ``run`` the hash of the window's lines, ``next`` the hashes of the
    next line and of those that start within ``min_chars`` characters of it.
    """
    lines = rows.select(*KEY, F.posexplode_outer(F.split("row.text", "\n", -1)).alias("line", "value")).select(
        *KEY, "line", F.xxhash64("value").alias("h"), (F.length("value") + 1).cast("bigint").alias("size")
    ).distinct()
    ordered = Window.partitionBy(*KEY).orderBy("line")
    placed = lines.withColumn("end", F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.withColumn("start", F.col("end") - F.col("size"))
    ahead = Window.partitionBy(*KEY).orderBy("start").rangeBetween(0, min_chars - 1)
    seen = placed.select(
        *KEY,
        "line",
        "start",
        F.last("line").over(ahead).alias("last"),
        F.last("end").over(ahead).alias("stop"),
        F.min(F.struct("h", "line")).over(ahead).alias("low"),
        F.collect_list("h").over(ahead).alias("hashes"),
    )
    seen = seen.withColumn("next", F.lead("hashes").over(Window.partitionBy(*KEY).orderBy("start")))
    return seen.where(F.col("stop") >= F.col("start") + min_chars).select(
        *KEY, "line", "last", F.col("low.h").alias("mark"), F.col("low.line").alias("mark_line"),
        F.xxhash64("hashes").alias("run"), F.coalesce("next", F.array().cast("array<bigint>")).alias("next"),
    )


def _equal(a: str, b: str) -> Column:
    """How many leading entries two arrays have in common."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differ > 0, differ - 1).otherwise(F.greatest(F.size(a), F.size(b))).cast("int")


def _blocks(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """``_null, _id, _hash, block`` and ``name``: the values of two blocks of lines from ``block`` on.

    Each line is in two rows, so that any ``BLOCK`` lines in a row lie whole in one of them. A line
    that ``rows`` does not have is null, and left out at the end.
    """
    number = F.floor(F.col("line") / BLOCK).cast("int")
    placed = rows.select(*KEY, "line", value.alias("value"), F.explode(F.array(number, number - 1)).alias("block")).where("block >= 0")
    entry = F.struct((F.col("line") - F.col("block") * BLOCK).alias("at"), "value")
    whole = placed.groupBy(*KEY, "block").agg(F.sort_array(F.collect_list(entry)).alias("held"))
    before = F.concat(F.array(F.lit(-1)), F.transform("held", lambda x: x["at"]))
    none = F.lit(None).cast(placed.schema["value"].dataType)

    def with_gap(x: Column, last: Column) -> Column:
        return F.when(x.isNull(), F.slice(F.array(none), 1, 0)).otherwise(
            F.concat(F.array_repeat(none, x["at"] - last - 1), F.array(x["value"]))
        )

    return whole.select(*KEY, "block", F.flatten(F.zip_with("held", before, with_gap)).alias(name))


def _followed(matches: DataFrame, near: DataFrame) -> DataFrame:
    """``_null, _id, _hash, line`` and ``s_null, s_id, s_hash, there``: the last equal windows of matches
    that go on past windows which first occurred elsewhere.

    A walker stands at a window (``line``) that equals one at ``there`` of the text it was matched
    with, and looks at the next block of windows of both, at twice as many blocks in each round.
    """
    theirs = [f"s{c}" for c in KEY]
    after = Window.partitionBy(*KEY).orderBy("line")
    ahead = matches.withColumns({"ahead": F.lead("line").over(after), "of": F.lead("first").over(after)})
    own = F.struct(*(F.col(f"first.{c}") for c in KEY), (F.col("first.line") + 1).alias("line"))
    other = F.struct(*(F.col(f"of.{c}") for c in KEY), F.col("of.line").alias("line"))
    leaves = (F.col("ahead") == F.col("line") + 1) & (F.col("next") == F.col("first.next")) & (own != other)
    walkers = ahead.where(leaves).select(
        *KEY, F.col("ahead").alias("line"), *(F.col(f"first.{c}").alias(t) for c, t in zip(KEY, theirs, strict=True)),
        (F.col("first.line") + 1).alias("there"),
    )
    walkers, reach, ends = stored(walkers, "walkers"), 1, []
    if walkers.isEmpty():
        return walkers
    # Which text a window was joined to, and how far apart the two lie.
    joined_to = F.xxhash64(*(F.col(f"first.{c}") for c in KEY), (F.col("first.line") - F.col("line")).cast("bigint"))
    mine = stored(_blocks(matches, F.struct("run", joined_to.alias("to")), "here"), "line-blocks")
    near = stored(_blocks(near, F.col("run"), "other"), "line-blocks")
    near = near.withColumnsRenamed({**dict(zip(KEY, theirs, strict=True)), "block": "block_there"})
    here = F.slice("here", F.col("at") % BLOCK + 1, BLOCK)
    there = F.slice("other", F.col("at_there") % BLOCK + 1, BLOCK)
    same = F.xxhash64(*theirs, (F.col("there") - F.col("line")).cast("bigint"))
    ok = F.zip_with(here, there, lambda x, y: F.coalesce((x["run"] == y) & (x["to"] != F.col("same")), F.lit(False)))
    bad = F.array_position("ok", False).cast("int")
    bad = F.when(F.col("ok").isNull(), 1).when(bad > 0, bad).when(F.size("ok") < BLOCK, F.size("ok") + 1)
    while not walkers.isEmpty():
        steps = walkers.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit((reach - 1) * BLOCK), F.lit(BLOCK)))).withColumns(
            {"at": F.col("line") + F.col("k") + 1, "at_there": F.col("there") + F.col("k") + 1, "same": same}
        )
        for name, at in (("block", "at"), ("block_there", "at_there")):
            steps = steps.withColumn(name, F.floor(F.col(at) / BLOCK).cast("int"))
        seen = steps.join(mine, [*KEY, "block"], "left").join(near, [*theirs, "block_there"], "left").withColumn("ok", ok)
        stop = F.min(F.col("k") + bad).alias("stop")
        walked = stored(seen.groupBy(*KEY, "line", *theirs, "there").agg(stop), "walked")
        ended = walked.where("stop IS NOT NULL")
        ends.append(ended.select(
            *KEY, (F.col("line") + F.col("stop") - 1).alias("line"), *theirs, (F.col("there") + F.col("stop") - 1).alias("there")
        ))
        walkers = walked.where("stop IS NULL").select(
            *KEY, (F.col("line") + reach * BLOCK).alias("line"), *theirs, (F.col("there") + reach * BLOCK).alias("there")
        )
        reach *= 2
    return reduce(DataFrame.union, ends, walkers)


def repeated_lines(docs: DataFrame, min_chars: int = 48) -> DataFrame:
    """``_id, _hash, removed``: the sorted numbers of the lines to delete, for documents that have any.

    The first occurrence, by document id (null last), text hash and line, stays. Every deleted line
    equals one that comes before it in this order, so no line is lost from all texts.
    """
    spark = docs.sparkSession
    repeats, matches = Held(spark, "line-repeats"), Held(spark, "line-matches")
    with working(spark, "line-windows"):
        found = stored(windows(keyed(docs.select("doc_id", "text")).where("row.text IS NOT NULL"), min_chars), "windows")
        position = F.struct(*KEY, "mark_line")
        # Two positions differ as soon as the least and the greatest do; both combine on the map side.
        marks = found.groupBy("mark").agg(F.min(position).alias("a"), F.max(position).alias("b"))
        # Stored, so that the joins have a shuffle on both sides, and their hot partitions are split.
        near = found.join(stored(marks.where("a != b").select("mark"), "marks"), "mark", "left_semi")
        near = repeats.put(near.select(*KEY, "line", "last", "run", "next"))
    at = F.struct(*KEY, "line", "next")
    with working(spark, "line-runs"):
        runs = near.groupBy("run").agg(F.min(at).alias("first"), F.max(at).alias("final"))
        again = near.join(stored(runs.where("first != final").select("run", "first"), "runs"), "run")
        again = matches.put(again.where(at != F.col("first")).select(*KEY, "line", "last", "run", "next", "first"))
    ends = Held(spark, "line-ends")
    with working(spark, "line-walks"):
        beyond = ends.put(_followed(again, near))
    theirs = near.select(*(F.col(c).alias(f"s{c}") for c in KEY), F.col("line").alias("there"), F.col("next").alias("next_there"))
    ends = beyond.join(again.select(*KEY, "line", "next"), [*KEY, "line"]).join(theirs, [f"s{c}" for c in KEY] + ["there"])
    late = ends.select(*KEY, "line", (F.col("line") + _equal("next", "next_there")).alias("till"))
    till = F.greatest(F.col("last"), F.col("line") + _equal("next", "first.next")).alias("till")
    cut = again.select(*KEY, "line", till).union(late).select(*KEY, F.explode(F.sequence("line", "till")).alias("line"))
    return cut.groupBy(*KEY).agg(F.sort_array(F.collect_set("line")).alias("removed"))


def dedup_lines(docs: DataFrame, min_chars: int = 48) -> DataFrame:
    """``row`` with the columns of ``docs``, its ``text`` freed of repeated runs, and ``n_lines``,
    ``n_removed`` (long).

    A null text stays null with no lines. An empty text has one empty line. A wholly repeated row
    shares its id and text with the first, so it is the same document and keeps the same lines.
    A text all of whose lines go becomes empty, very long texts are taken whole, other columns are
    only passed on. An empty table gives an empty one.
    """
    # The lines are cut before the join: after it they are a column, which the lambda only slices.
    rows = keyed(docs).withColumn("lines", F.split("row.text", "\n", -1))
    spark = docs.sparkSession
    found = Held(spark, "removed-lines")
    with working(spark, "line-dedup"):  # only the numbers of the lines stay on disk while texts move
        removed = found.put(repeated_lines(docs, min_chars))
    joined = rows.join(removed, list(KEY), "left")
    gaps = F.zip_with(
        F.concat(F.array(F.lit(-1)), "removed"),
        F.concat("removed", F.array(F.size("lines"))),
        lambda a, b: F.slice(F.col("lines"), a + 2, b - a - 1),
    )
    kept = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(F.array_join(F.flatten(gaps), "\n"))
    return joined.select(
        F.col("row").withField("text", kept).alias("row"),
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
    )
