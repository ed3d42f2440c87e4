"""Exact repeated substrings over all texts, by a suffix array of sampled places, sorted deep-shallow.

A window is a string of ``size`` bytes. Of the hashes of the ``GRAM``-byte strings in it the least,
and of equal ones the first, is its anchor: equal windows have equal anchors. Windows that follow
each other and share an anchor make a run, one row; runs of one text with the same whole context are
one row too, however often they follow each other. Runs with the same whole context repeat in all
their windows. A run whose context occurs once but whose anchor does not is a border: for these
alone windows are compared one by one. All windows of borders with one anchor are sorted as
suffixes, by multikey quicksort to a shallow depth and by blind tries where prefixes that long are
still equal; equal neighbours are repeated.

An anchor with very many borders is cut into groups that are small enough to sort. Equal windows
hold their anchor at the same place, so borders are dealt by halves of these places: windows that
hold it in one half agree in all bytes that every such window has around it. Borders that agree in
all bytes of all their windows there repeat in them, and one of them goes on for all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import KEY, keyed, stored

#: Bytes of an anchor (a power of two); bytes hashed at once; bits of a place in them.
GRAM, CHUNK, BITS = 32, 1 << 20, 22
#: Border contexts that are sorted together at most, and in a batch.
TOGETHER, BATCH = 4096, 8192
#: Bytes that multikey quicksort looks at before blind tries take over: two machine words.
SHALLOW = 16


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the ``GRAM`` bytes from each place on."""
    with np.errstate(over="ignore"):
        h, step, by = data.astype(np.uint64) + np.uint64(1), 1, np.uint64(0x9E3779B97F4A7C15)
        while step < GRAM:
            h = h[:-step] * by + h[step:]
            by, step = by * by, 2 * step
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h


def runs_of(data: np.ndarray, ok: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, tuple]:
    """``(first window, windows, (place of the anchor from there, its hash))`` of each run; ``ok`` says which windows count.

    ``data`` has less than ``2 ** BITS`` bytes, so that the place in the low bits decides between
    equal hashes for the first one.
    """
    h = gram_hashes(data)
    low = np.uint64((1 << BITS) - 1)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    wide, step = size - GRAM + 1, 1
    while 2 * step <= wide:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[: len(data) - size + 1], least[wide - step :][: len(data) - size + 1])
    anchor = (least & low).astype(np.int64)
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (ok[1:] != ok[:-1])]
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(anchor)])
    keep = ok[first]
    first, count = first[keep], count[keep]
    return first, count, (anchor[first] - first, h[anchor[first]].view(np.int64))


def joined_stretches(start: np.ndarray, windows: np.ndarray) -> list[tuple[int, int]]:
    """``(start, windows)`` of runs in order, those that follow each other as one."""
    new = np.r_[True, start[1:] != start[:-1] + windows[:-1]]
    begin = np.flatnonzero(new)
    stop = np.r_[begin[1:], len(start)] - 1
    return list(zip(start[begin].tolist(), (start[stop] + windows[stop] - start[begin]).tolist(), strict=True))


def _blocks(texts: list[bytes], size: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """``(bytes, number of the text, place in it)`` in blocks: short texts together, long ones in parts."""
    parts, numbers, places, total = [], [], [], 0

    def block():
        return b"".join(parts), np.concatenate(numbers), np.concatenate(places)

    for i, text in enumerate(texts):
        if len(text) < size:
            continue
        for at in range(0, len(text) - size + 1, CHUNK):  # parts overlap: every window lies in one
            part = text[at : at + CHUNK + size - 1]
            parts.append(part)
            numbers.append(np.full(len(part), i, np.int64))
            places.append(np.arange(at, at + len(part), dtype=np.int64))
            total += len(part)
            if total >= CHUNK:
                yield block()
                parts, numbers, places, total = [], [], [], 0
    if parts:
        yield block()


def runs(rows: DataFrame, size: int) -> DataFrame:
    """``_null, _id, _hash, anchor, c1, c2, start, windows, at, times, own`` for the runs of ``rows (..., text)``.

    ``c1, c2`` are a 128-bit digest of the context. A context that a text (or a part of a long one)
    holds several ``times`` is one row; ``own`` are the stretches of all of them, else null.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch["text"]]
            for data, number, place in _blocks(texts, size):
                view = np.frombuffer(data, np.uint8)
                # Within one text, and within one part of a long one.
                ok = (number[size - 1 :] == number[: len(view) - size + 1]) & (
                    place[size - 1 :] - place[: len(view) - size + 1] == size - 1
                )
                first, count, (at, anchor) = runs_of(view, ok, size)
                ends = (first + count - 1 + size).tolist()
                digest = xxhash.xxh3_128_digest
                raw = b"".join(digest(data[a:b]) for a, b in zip(first.tolist(), ends, strict=True))
                context = np.frombuffer(raw, np.int64).reshape(-1, 2)
                # Equal contexts of a text next to each other, in order of their places.
                order = np.lexsort((context[:, 1], context[:, 0], number[first]))
                same = (number[first][order][1:] == number[first][order][:-1]) & (
                    context[order][1:] == context[order][:-1]
                ).all(axis=1)
                begin = np.flatnonzero(np.r_[True, ~same]) if len(order) else np.zeros(0, np.int64)
                times = np.diff(np.r_[begin, len(order)])
                one = order[begin]
                own = [None] * len(one)
                for i in np.flatnonzero(times > 1).tolist():
                    members = order[begin[i] : begin[i] + times[i]]
                    own[i] = [
                        {"start": a, "windows": n} for a, n in joined_stretches(place[first[members]], count[members])
                    ]
                rows = batch.iloc[number[first[one]]]
                yield pd.DataFrame(
                    {
                        **{k: rows[k].to_numpy() for k in KEY},
                        "anchor": anchor[one],
                        "c1": context[one, 0],
                        "c2": context[one, 1],
                        "start": place[first[one]],
                        "windows": count[one].astype(np.int32),
                        "at": at[one].astype(np.int32),
                        "times": times.astype(np.int32),
                        "own": own,
                    }
                )

    kind = dict(rows.dtypes)["_id"]
    return rows.select(*KEY, "text").mapInPandas(
        find,
        f"_null boolean, _id {kind}, _hash long, anchor long, c1 long, c2 long, start long, windows int, at int, "
        "times int, own array<struct<start:long,windows:int>>",
    )


class BlindTrie:
    """Strings of ``size`` bytes in ``data``, in order, by a trie that keeps only branching places.

    A string goes down by its bytes at those places alone, then is compared once, with the leaf it
    came to; where they differ its own branch begins. Equal strings share a leaf.
    """

    def __init__(self, data: bytes, size: int):
        self.data, self.size, self.root = data, size, None

    def insert(self, at: int) -> None:
        data, size = self.data, self.size
        if self.root is None:
            self.root = [at]
            return
        path, node = [], self.root
        while isinstance(node, tuple):
            path.append(node)
            depth, kids = node
            byte = data[at + depth]
            node = kids[byte] if byte in kids else next(iter(kids.values()))
        other = node[0]
        if data[at : at + size] == data[other : other + size]:
            node.append(at)
            return
        low, high = 0, size  # the common prefix is in [low, high)
        while high - low > 1:
            middle = (low + high) // 2
            if data[at + low : at + middle] == data[other + low : other + middle]:
                low = middle
            else:
                high = middle
        above = None
        for node in path:
            if node[0] >= low:
                break
            above = node
        below = self.root if above is None else above[1][data[at + above[0]]]
        if isinstance(below, tuple) and below[0] == low:
            below[1][data[at + low]] = [at]
            return
        fork = (low, {data[other + low]: below, data[at + low]: [at]})
        if above is None:
            self.root = fork
        else:
            above[1][data[at + above[0]]] = fork

    def leaves(self) -> Iterator[list[int]]:
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += [kid for _, kid in sorted(node[1].items(), reverse=True)]
            else:
                yield node


def equal_classes(data: bytes, starts: np.ndarray, size: int) -> Iterator[list[int]]:
    """The places of ``starts`` in groups with equal ``size`` bytes, those that are alone left out."""
    view = np.frombuffer(data, np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(view, 8)
    first = words[starts].copy().view(">u8").ravel()
    second = words[starts + 8].copy().view(">u8").ravel()
    order = np.lexsort((second, first))  # multikey sort, a machine word as one symbol
    first, second, sorted_starts = first[order], second[order], starts[order]
    new = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
    begin = np.flatnonzero(new)
    length = np.diff(np.r_[begin, len(new)])
    for a, n in zip(begin[length > 1].tolist(), length[length > 1].tolist(), strict=True):
        trie = BlindTrie(data, size)
        for at in sorted_starts[a : a + n].tolist():
            trie.insert(at)
        for leaf in trie.leaves():
            if len(leaf) > 1:
                yield leaf


def border_windows(contexts: DataFrame, size: int) -> DataFrame:
    """``_null, _id, _hash, start, windows``: of ``contexts (..., lot, start, bytes)`` the windows that
    others of the same lot repeat, joined to stretches. No lot has more than ``TOGETHER`` contexts."""

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if len(held) < BATCH:
                continue
            last = held["lot"] == held["lot"].iloc[-1]
            if not last.all():
                yield stretches(held[~last])
                held = held[last].reset_index(drop=True)
        if held is not None and len(held):
            yield stretches(held)

    def stretches(held: pd.DataFrame) -> pd.DataFrame:
        data = b"".join(held["bytes"])
        lengths = held["bytes"].map(len).to_numpy(np.int64)
        at = np.cumsum(lengths) - lengths
        count = lengths - size + 1
        owner = np.repeat(np.arange(len(held)), count)
        starts = at[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        repeated = np.zeros(len(data) + 1, bool)
        for found in equal_classes(data, starts, size):
            repeated[found] = True
        hit = repeated[starts]
        # A stretch is a maximal row of repeated windows in one context.
        edge = np.flatnonzero(hit & ~np.r_[False, hit[:-1] & (owner[1:] == owner[:-1])])
        stop = np.flatnonzero(hit & ~np.r_[hit[1:] & (owner[1:] == owner[:-1]), False])
        rows = held.iloc[owner[edge]]
        return pd.DataFrame(
            {
                **{k: rows[k].to_numpy() for k in KEY},
                "start": rows["start"].to_numpy(np.int64) + starts[edge] - at[owner[edge]],
                "windows": (stop - edge + 1).astype(np.int32),
            }
        )

    kind = dict(contexts.dtypes)["_id"]
    dealt = contexts.repartition("lot").sortWithinPartitions("lot")
    return dealt.mapInPandas(sort, f"_null boolean, _id {kind}, _hash long, start long, windows int")


def split_borders(borders: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Borders of crowded anchors as lots to sort, and what is known to repeat on the way there.

    ``borders``: ``_null, _id, _hash, lot, start, windows, at, bytes``. A border's windows hold the
    anchor at places ``low`` to ``high``; a lot is about the places ``a`` to ``b``. All its windows
    have ``a`` bytes before the anchor and ``size - GRAM - b`` behind it in common. While a lot has
    more than ``TOGETHER`` borders, those with equal windows are told apart by their bytes, all but
    one of them are done, and the places are halved: a border makes two rows at most, nine times.
    """
    last = size - GRAM
    lots, known = [], []
    name = F.struct(*KEY, "start")
    work = borders.select(
        *KEY, "lot", "start", "at", "bytes", (F.col("at") - F.col("windows") + 1).alias("low"), F.col("at").alias("high"),
        F.lit(0).alias("a"), F.lit(last).alias("b"),
    )
    trimmed = (
        *KEY, "lot", F.expr("start + at - high").alias("start"), F.expr(f"substring(bytes, at - high + 1, high - low + {size})").alias("bytes"),
    )
    while not work.isEmpty():
        counts = stored(work.groupBy("lot").agg(F.count("*").alias("n")).where("n > 1"), "lot-sizes")
        sized = stored(work.join(counts, "lot"), "lots")
        lots.append(sized.where(F.col("n") <= TOGETHER).select(*trimmed))
        crowded = sized.where(F.col("n") > TOGETHER).drop("n").withColumn(
            "span", F.expr(f"substring(bytes, at - high + 1, high - low + {size})")
        )
        alike = ["lot", "low", "high", "span"]
        twins = crowded.groupBy(*alike).agg(F.count("*").alias("n"), F.min(name).alias("one")).where("n > 1")
        met = stored(crowded.join(stored(twins, "twins"), alike, "left"), "crowded")
        known.append(met.where("n > 1").select(*KEY, F.expr("start + at - high").alias("start"),
                                               F.expr("high - low + 1").cast("int").alias("windows")))
        half = F.expr("CAST((a + b) div 2 AS INT)")
        halves = F.explode(F.array(F.struct(F.col("a").alias("a"), half.alias("b")), F.struct((half + 1).alias("a"), F.col("b").alias("b"))))
        rest = met.where((F.col("n").isNull() | (F.col("one") == name)) & (F.col("a") < F.col("b"))).withColumn("half", halves)
        shared = F.expr(f"substring(bytes, at - half.a + 1, half.a - half.b + {size})")
        work = rest.select(
            *KEY, F.xxhash64("lot", "half", shared).alias("lot"), "start", "at", "bytes",
            F.greatest("low", "half.a").alias("low"), F.least("high", "half.b").alias("high"), "half.a", "half.b",
        ).where("low <= high")
        work = stored(work, "halved-lots")
    empty = borders.limit(0)
    whole = reduce(DataFrame.union, lots, empty.select(*KEY, "lot", "start", "bytes"))
    return whole, reduce(DataFrame.union, known, empty.select(*KEY, "start", "windows"))


def repeated_windows(docs: DataFrame, size: int) -> DataFrame:
    """``_null, _id, _hash, start, windows``: stretches of windows whose bytes also start elsewhere."""
    rows = keyed(docs.select("doc_id", "text")).select(*KEY, "row.text")
    found = runs(rows, size)
    # Runs are found twice, for the counts and to be kept: that costs less than to store all of them.
    anchors = found.groupBy("anchor").agg(
        F.sum("times").alias("total"),
        *(f(c).alias(f"{name}_{c}") for c in ("c1", "c2") for name, f in (("low", F.min), ("high", F.max))),
    )
    # Stored, so that the join below has a shuffle on both sides, and its hot partitions are split.
    mixed = (F.col("low_c1") != F.col("high_c1")) | (F.col("low_c2") != F.col("high_c2"))
    again = stored(anchors.where("total > 1").select("anchor", mixed.alias("mixed")), "anchors")
    near = stored(found.join(again, "anchor").withColumn("place", F.monotonically_increasing_id()), "repeated-anchors")
    context = ["anchor", "c1", "c2"]
    all_rows = near
    near = near.where("mixed").drop("mixed")
    contexts = near.groupBy(*context).agg(F.sum("times").alias("n"), F.min("place").alias("one"))
    kinds = contexts.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("rarest"))
    known = contexts.join(kinds, "anchor").select(
        *context, "n", "one", (F.col("rarest") == 1).alias("border"), "kinds"
    )
    met = stored(near.join(known, context).where("n > 1 OR place = one"), "mixed-anchors")
    every = F.coalesce("own", F.array(F.struct("start", "windows")))
    alike = [part.select(*KEY, F.explode(every).alias("x")) for part in (all_rows.where("NOT mixed"), met.where("n > 1"))]
    whole = alike[0].union(alike[1]).select(*KEY, "x.start", "x.windows")

    # One context of each kind around a border's anchor, brought with its bytes.
    wanted = met.where("border AND place = one").groupBy(*KEY).agg(
        F.collect_list(
            F.struct("anchor", "start", "windows", "at", (F.col("kinds") > TOGETHER).alias("crowded"))
        ).alias("wanted")
    )
    names = ["lot", "start", "windows", "at", "bytes", "crowded"]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for *key, text, places in batch[[*KEY, "text", "wanted"]].itertuples(index=False):
                data = (text or "").encode()
                for x in places:
                    held = data[x["start"] : x["start"] + x["windows"] - 1 + size]
                    out.append((*key, x["anchor"], x["start"], x["windows"], x["at"], held, x["crowded"]))
                if len(out) >= 20_000:
                    yield pd.DataFrame(out, columns=[*KEY, *names])
                    out = []
            if out:
                yield pd.DataFrame(out, columns=[*KEY, *names])

    kind = dict(rows.dtypes)["_id"]
    borders = rows.join(wanted, list(KEY)).mapInPandas(
        cut, f"_null boolean, _id {kind}, _hash long, lot long, start long, windows int, at int, bytes binary, crowded boolean"
    )
    crowds = not met.where(F.col("border") & (F.col("kinds") > TOGETHER)).isEmpty()
    if not crowds:
        return whole.union(border_windows(borders.select(*KEY, "lot", "start", "bytes"), size))
    borders = stored(borders, "borders")
    split, seen = split_borders(borders.where("crowded").drop("crowded"), size)
    lots = borders.where("NOT crowded").select(*KEY, "lot", "start", "bytes").union(split)
    return whole.union(border_windows(lots, size)).union(seen)


def spans_of(stretches: list, size: int) -> list[tuple[int, int]]:
    """The maximal byte spans that windows cover."""
    out: list = []
    for start, windows in sorted((int(x["start"]), int(x["windows"])) for x in stretches):
        end = start + windows - 1 + size
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def cut_repeats(docs: DataFrame, size: int = 200) -> DataFrame:
    """``doc_id, kept binary, n_bytes, n_removed, n_spans, kept_sha256`` for each row of ``docs``.

    Every byte that a repeated ``size``-byte string covers goes, in all places where it occurs,
    overlapping ones and ones in the same text included. A null text is an empty one. Wholly
    repeated rows repeat each other, so nothing that long is left of them. Texts shorter than
    ``size`` stay. Other columns are not looked at; an empty table gives an empty one.
    """
    rows = keyed(docs.select("doc_id", "text"))
    found = repeated_windows(docs, size).groupBy(*KEY).agg(
        F.collect_list(F.struct("start", "windows")).alias("stretches")
    )

    @F.pandas_udf("kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def keep(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, stretches in parts:
            out = []
            for text, own in zip(texts, stretches, strict=True):
                data = (text or "").encode()
                spans = spans_of(own if own is not None else [], size)
                bounds = [0, *(x for span in spans for x in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
                out.append((kept, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = rows.join(found, list(KEY), "left")
    return joined.select("row.doc_id", keep("row.text", "stretches").alias("x")).select("doc_id", "x.*")
