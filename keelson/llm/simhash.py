"""Near duplicates by SimHash fingerprints, found with pigeonring filtering.

A fingerprint has 64 bits, four segments of 16 in a ring. If two fingerprints differ in at most
three bits, then by the pigeonring principle some segment starts a chain whose first ``l`` segments
differ in at most ``3 l / 4`` bits together, for each ``l``: 0, 1, 2, 3. Budgets hold for parts of
segments too, which gives keys of three widths to join on. The first segment is equal in all.

* 24 bits, 8 keys a fingerprint: the second segment differs in one bit at most, so one half is equal.
* 32 bits, 20 keys: the second is equal, or else one half of it and, as the third then has one bit
  left, one half of the third.
* 40 bits, 88 keys: the second is equal and, with two bits left, two quarters of the third; or three
  quarters of the second and three of the third.

Each width finds every pair. The one that makes least rows for the number of fingerprints is taken,
so that the candidates of a fingerprint stay few in large collections. What the join brings together
passes the budgets of the whole chain before the Hamming distance counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.common import KEY, components, key_id, keyed, stored
from keelson.session import Held, working

#: Fixed values of this filter: bits that may differ, segments, bits of a segment.
DISTANCE, SEGMENTS, WIDTH = 3, 4, 16


def _plans() -> dict[int, list[tuple[tuple[int, int, int], ...]]]:
    """Per width of a key the keys that a chain's start gives. A key is made of pieces: the segment,
    counted from the start, the lowest bit in it and the number of bits."""
    first, second = (0, 0, WIDTH), (1, 0, WIDTH)

    def some(segment: int, parts: int, equal: int) -> list[tuple[tuple[int, int, int], ...]]:
        size = WIDTH // parts
        return [tuple((segment, at * size, size) for at in chosen) for chosen in combinations(range(parts), equal)]

    halves, quarters = product(some(1, 2, 1), some(2, 2, 1)), product(some(1, 4, 3), some(2, 4, 3))
    return {
        24: [(first, *x) for x in some(1, 2, 1)],
        32: [(first, second), *((first, *x, *y) for x, y in halves)],
        40: [*((first, second, *y) for y in some(2, 4, 2)), *((first, *x, *y) for x, y in quarters)],
    }


PLANS = _plans()


def key_width(n: int) -> int:
    """The width whose keys make the least rows and candidates for ``n`` evenly spread fingerprints."""
    return min(PLANS, key=lambda width: len(PLANS[width]) * (1 + n / 2**width))


def fingerprint(text: str | None, length: int = 3) -> int:
    """The signed 64-bit SimHash of a text's word shingles; 0 for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= length:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        pieces = zip(starts[: len(words) - length + 1].tolist(), ends[length - 1 :].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], 42) for a, b in pieces], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded working memory for long texts
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, length: int = 3, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` and a bigint column with the fingerprint of each whole text."""

    @F.pandas_udf(T.LongType())
    def simhash(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([fingerprint(t, length) for t in part], dtype="int64")

    return docs.withColumn(name, simhash(F.col(text)))


def _keys(width: int) -> list[Column]:
    """The keys of a ``fingerprint``, as bigints: which key it is, the segment its chain starts with
    (the lowest two bits of that number), then the bits."""
    keys = []
    for number, (pieces, start) in enumerate(product(PLANS[width], range(SEGMENTS))):
        key = F.lit(number << width)
        at = width
        for segment, low, size in pieces:
            at -= size
            bits = F.shiftrightunsigned("fingerprint", WIDTH * ((start + segment) % SEGMENTS) + low)
            key = key.bitwiseOR(F.shiftleft(bits.bitwiseAND((1 << size) - 1), at))
        keys.append(key)
    return keys


def links(prints: DataFrame, width: int | None = None) -> DataFrame:
    """All pairs ``(u, v)`` of different ``fingerprint`` values at most three bits apart, u < v.

    ``width`` is one of ``PLANS``; all give the same pairs. By default the number of rows decides.
    """
    mask = (1 << WIDTH) - 1
    width = width or key_width(prints.count())
    spread = prints.select("fingerprint").distinct().select(
        "fingerprint", F.explode(F.array(*_keys(width))).alias("key")
    )
    a, b = spread.alias("a"), spread.alias("b")
    differ = F.col("a.fingerprint").bitwiseXOR(F.col("b.fingerprint"))
    step = F.shiftright(F.col("a.key"), width).bitwiseAND(SEGMENTS - 1)  # the segment the chain starts with
    counts = [F.bit_count(F.shiftrightunsigned(differ, WIDTH * i).bitwiseAND(mask)) for i in range(SEGMENTS)]
    budgets = [(chain * DISTANCE) // SEGMENTS for chain in range(1, SEGMENTS + 1)]
    viable = F.lit(False)
    for start in range(SEGMENTS):
        ok, total = step == start, F.lit(0)
        for chain, budget in enumerate(budgets):
            total = total + counts[(start + chain) % SEGMENTS]
            ok = ok & (total <= budget)
        viable = viable | ok
    near = (F.bit_count(differ) <= DISTANCE) & viable
    on = (F.col("a.key") == F.col("b.key")) & (F.col("a.fingerprint") < F.col("b.fingerprint")) & near
    return a.join(b, on).select(F.col("a.fingerprint").alias("u"), F.col("b.fingerprint").alias("v")).distinct()


def groups(docs: DataFrame, length: int = 3) -> DataFrame:
    """``_null, _id, _hash, fingerprint, component_id, keep_hash`` for each row of ``docs (doc_id, text)``.

    ``component_id`` is the smallest id that links reach, ``keep_hash`` the smallest text hash under
    that id: together they name the one document that stays. A null text is an empty one, and all
    texts without words share fingerprint 0. Copies meet as one fingerprint before any join, so
    their number does not matter. A null id ranks after all others and is a component's id only if
    all its ids are null. Other columns are not looked at; an empty table gives an empty one.
    """
    rows = with_fingerprint(keyed(docs.select("doc_id", "text")), length, "row.text")
    rows = stored(rows.select(*KEY, "fingerprint"), "simhash-prints")
    nodes = stored(rows.groupBy("fingerprint").agg(F.min(F.struct(*KEY)).alias("first")), "simhash-nodes")
    held = Held(docs.sparkSession, "simhash-components")
    with working(docs.sparkSession, "simhash-links"):
        found = held.put(components(links(nodes)))
    roots = nodes.join(found, nodes.fingerprint == found.node, "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    best = roots.groupBy("root").agg(F.min("first").alias("best"))
    named = roots.join(best, "root").select("fingerprint", "best")
    return rows.join(named, "fingerprint").select(
        *KEY, "fingerprint", key_id("best.").alias("component_id"), F.col("best._hash").alias("keep_hash")
    )


def keep_one(docs: DataFrame, length: int = 3) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of every component the document with the
    smallest id stays, once. Columns are those of ``docs``."""
    kept = groups(docs, length).where(key_id().eqNullSafe(F.col("component_id")) & (F.col("_hash") == F.col("keep_hash")))
    kept = stored(kept.select(*KEY).distinct(), "simhash-kept")
    return keyed(docs).join(kept, list(KEY), "left_semi").dropDuplicates(list(KEY)).select("row.*")
