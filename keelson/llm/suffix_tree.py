"""Scoring texts with a probabilistic suffix tree over words.

Tokens are lower-case words and one end for each text. A word that occurs as often as a context must
is a symbol of its own, at any size; rarer ones, which cannot make a context, share symbols by their
last bytes that occur as often together. Contexts of one to ``depth`` symbols are counted where they
occur often enough; the count that is needed grows far more slowly than the texts, so that symbols
and tree grow with them. A context is retained if its next-symbol distribution diverges from that of
its longest retained suffix, and is smoothed with it. A token's probability is that of its symbol
after the longest retained context, times its own share of the symbol.

Vocabulary and counts are tables. What follows a context is counted in blocks of codes, dealt by the
last symbol of the context and the next one, so that a code and those of its suffixes meet in one
block, and a frequent context is spread over all. What is broadcast or comes to the driver is tokens
of at least ``1 / COMMON`` of all or as frequent as a context, contexts, of which a level has at most
``SLOWLY`` times the root of the training tokens, and a tree of at most ``SMALL`` entries; of a larger
one, each chunk of texts asks the blocks for the codes that it holds.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import stored

END = b" "  # no word holds a blank
#: A token of at least 1/COMMON of the training tokens is broadcast; entries of a worker's tables.
COMMON, ENTRIES = 1_000_000, 400_000
#: Symbols of a context at most.
DEPTH = 3
#: The least count of a context and of a symbol: a fixed one, or the root of the training tokens over
#: ``SLOWLY`` if that is more, so that the tree grows with the texts but more slowly.
LEAST, SLOWLY = 48, 24
#: Tokens that a task encodes at once, of a chunk of texts, and for each block of codes.
TOGETHER, CHUNK, BLOCK = 1 << 19, 1 << 21, 1 << 20
#: Entries of a tree that is broadcast at most.
SMALL = 1 << 22
#: Least divergence of a context in nats, and the weight of its suffix in the smoothing.
DIVERGENCE, SMOOTHING = 0.005, 50.0


def frequent(n: int, least: int = LEAST) -> float:
    """The least count of a context and of a symbol among ``n`` training tokens."""
    return max(least, n**0.5 / SLOWLY)


def words(text: str | None) -> list[bytes]:
    found = (text or "").encode().lower().split()
    found.append(END)
    return found


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def _tail(word: bytes) -> int:
    """The last two bytes of a word as a number."""
    return int.from_bytes(word[-2:], "big")


def vocabulary(docs: DataFrame) -> DataFrame:
    """``hash, tail, count`` of every token of ``docs (text)``."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def flush():
            keys = list(seen)
            out = pd.DataFrame(
                {
                    "hash": np.array([_hash(w) for w in keys], np.int64),
                    "tail": np.array([_tail(w) for w in keys], np.int32),
                    "count": np.fromiter(seen.values(), np.int64, len(keys)),
                }
            )
            seen.clear()
            return out

        for part in parts:
            for text in part["text"]:
                seen.update(words(text))
                if len(seen) > ENTRIES:
                    yield flush()
        if seen:
            yield flush()

    counted = docs.select("text").mapInPandas(count, "hash long, tail int, count long")
    return counted.groupBy("hash").agg(F.first("tail").alias("tail"), F.sum("count").alias("count"))


class Alphabet:
    """Symbols, and the common tokens with their counts.

    A word that occurs ``frequent`` times is a symbol: at most ``SLOWLY`` times the root of the tokens.
    """

    def __init__(self, vocab: DataFrame, least: int = LEAST):
        row = vocab.agg(F.sum("count").alias("n"), F.count("*").alias("v")).first()
        self.n, self.v = row["n"] or 0, row["v"]
        enough = frequent(self.n, least)
        common = vocab.where(F.col("count") >= min(self.n / COMMON, enough)).orderBy("hash").toPandas()
        self.hashes = common["hash"].to_numpy(np.int64)
        self.counts = common["count"].to_numpy(np.int64)
        rare = vocab.where(F.col("count") < enough).groupBy("tail").agg(
            F.sum("count").alias("count"), F.count("*").alias("types")
        ).toPandas()  # two bytes: 65,536 rows at most
        tails = rare["tail"].to_numpy(np.int64)
        mass, types = rare["count"].to_numpy(np.int64), rare["types"].to_numpy(np.int64)
        own = np.flatnonzero(self.counts >= enough)
        self.of_common = np.full(len(self.hashes), -1, np.int64)
        self.of_common[own] = np.arange(len(own))
        weight = [int(c) + 1 for c in self.counts[own]]
        # Two bytes name a symbol if they are common enough, else the last one, else all others.
        self.of_tail = np.full(1 << 16, -1, np.int64)
        for group in (tails, tails & 255):
            left = self.of_tail[tails] < 0
            sums = np.bincount(group[left], weights=mass[left], minlength=1)
            for value in np.flatnonzero(sums >= enough).tolist():
                found = left & (group == value)
                if group is tails:
                    self.of_tail[value] = len(weight)
                else:
                    every = np.flatnonzero((np.arange(1 << 16) & 255) == value)
                    self.of_tail[every[self.of_tail[every] < 0]] = len(weight)
                weight.append(int((mass + types)[found].sum()))
        left = self.of_tail[tails] < 0
        self.of_tail[self.of_tail < 0] = len(weight)
        weight.append(int((mass + types)[left].sum()) + 1)  # and one for what no training text holds
        self.base = np.array(weight, float) / (self.n + self.v + 1)
        self.size = len(weight)
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"  # of a stored symbol


class _Coder(dict):
    """Word to its place among the words met. Of each, once ``resolve`` has been called: its hash, its
    symbol, and its place among the common tokens or -1."""

    def __init__(self, alphabet: Alphabet):
        self.a, self.new = alphabet, []
        self.forget()

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = code = len(self)
        return code

    def resolve(self) -> None:
        a, hashes = self.a, np.array([_hash(w) for w in self.new], np.int64)
        tails = np.array([_tail(w) for w in self.new], np.int64)
        common, place = found(a.hashes, hashes)
        symbols, places = a.of_tail[tails], np.where(common, place, -1)
        own = a.of_common[place[common]]
        symbols[common] = np.where(own < 0, symbols[common], own)
        self.hashes, self.symbols, self.places = (
            np.concatenate(x) for x in ((self.hashes, hashes), (self.symbols, symbols), (self.places, places))
        )
        self.new = []

    def forget(self) -> None:
        self.clear()
        self.hashes = self.symbols = self.places = np.empty(0, np.int64)


def encoded(docs: DataFrame, alphabet: Alphabet, train: Column) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: its symbols, the sum over common tokens, the rare tokens,
    and the chunk of some ``CHUNK`` tokens that it is in."""
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(alphabet)

    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a: Alphabet = shared.value
        logs = np.append(np.log10(a.counts + 1.0), 0.0)  # at -1: no common token
        coder = _Coder(a)
        chunk, tokens = TaskContext.get().partitionId() << 32, 0

        def rows(held: list[np.ndarray]) -> pd.DataFrame:
            coder.resolve()
            sizes = np.array([len(x) for x in held])
            codes, begin = np.concatenate(held), np.cumsum(sizes) - sizes
            places = coder.places[codes]
            rare = places < 0
            n_rare = np.add.reduceat(rare, begin, dtype=np.int64)
            symbols, width = coder.symbols[codes].astype(a.kind).tobytes(), int(a.kind[-1])
            out = {
                "n_tokens": sizes, "n_common": sizes - n_rare, "common_sum": np.add.reduceat(logs[places], begin),
                "symbols": [symbols[i * width : (i + n) * width] for i, n in zip(begin.tolist(), sizes.tolist(), strict=True)],
                "rare": np.split(coder.hashes[codes[rare]], np.cumsum(n_rare)[:-1]), "chunk": chunk,
            }
            return pd.DataFrame(out)

        for part in parts:
            out, held, size = [], [], 0
            for i, text in enumerate(part["text"], 1):
                met = words(text)
                held.append(np.fromiter(map(coder.__getitem__, met), np.int32, len(met)))
                size += len(met)
                if size >= TOGETHER or i == len(part):
                    out.append(rows(held))
                    tokens += size
                    held, size = [], 0
                    if len(coder) > ENTRIES:
                        coder.forget()
                    if tokens >= CHUNK:
                        chunk, tokens = chunk + 1, 0
            if out:
                doc_id = part["doc_id"].astype("Int64") if kind == "bigint" else part["doc_id"]
                yield pd.concat(out, ignore_index=True).assign(doc_id=doc_id.values, train=part["train"].values)

    schema = (
        f"n_tokens long, n_common long, common_sum double, symbols binary, rare array<long>, chunk long, doc_id {kind}, train boolean"
    )
    return docs.select("doc_id", "text", train.alias("train")).mapInPandas(encode, schema).withColumn(
        "row", F.monotonically_increasing_id()
    )


def found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the wanted are among the sorted ``keys``, and where (0 for others)."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    inside = keys[at] == wanted
    return inside, np.where(inside, at, 0)


def pack(numbers: np.ndarray) -> bytes:
    """Numbers of at least 0, compressed byte by byte: first the lowest bytes of all, and so on."""
    few = numbers.astype(np.min_scalar_type(numbers.max()))
    return zlib.compress(few.view(np.uint8).reshape(len(few), -1).T.tobytes(), 1)


def unpack(raw: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(-1, size)
    return np.ascontiguousarray(planes.T).view(f"<u{len(planes)}").ravel().astype(np.int64)


class Contexts:
    """The contexts that are counted, by level, and the totals of the retained ones.

    A context of one symbol has its number. One of more is a code of the level below that occurs often
    enough, and has its place among those: ``codes[level]``, sorted. A code is the number of a context
    times ``k`` plus the next symbol. ``last`` is a context's last symbol, ``suffix`` the number of the
    context without its first symbol, on the level below.
    """

    def __init__(self, base: np.ndarray):
        self.base, self.k = base, len(base)
        self.codes: dict[int, np.ndarray] = {}
        self.last, self.suffix = {1: np.arange(self.k)}, {}
        self.totals: dict[int, np.ndarray] = {}  # 0: not retained

    def add(self, level: int, codes: np.ndarray) -> None:
        before, last = np.divmod(codes, self.k)
        self.codes[level], self.last[level] = codes, last
        # The context without its first symbol occurs as often at least, so that it is there.
        self.suffix[level] = last if level == 2 else found(self.codes[level - 1], self.suffix[level - 1][before] * self.k + last)[1]

    def places(self, x: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each level, where in ``x`` a symbol follows a counted context, and the codes there.
        ``place`` is where in its text a symbol is."""
        at = np.flatnonzero(place >= 1)
        codes = x[at - 1] * self.k + x[at]
        yield at, codes
        for level in sorted(self.codes):
            inside, number = found(self.codes[level], codes)
            at, number = at[inside] + 1, number[inside]
            within = at < len(x)
            within[within] = place[at[within]] >= 1
            at = at[within]
            codes = number[within] * self.k + x[at]
            yield at, codes

    def block(self, level: int, codes: np.ndarray, blocks: int) -> np.ndarray:
        """The block of a code: by the context's last symbol and the next one."""
        context, following = np.divmod(codes, self.k)
        first = (self.last[level][context] * self.k + following).astype(np.uint64)
        return ((first * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(blocks)

    def smoothed(self, level: int, context: np.ndarray, n: np.ndarray, p: np.ndarray, smoothing: float) -> np.ndarray:
        """Probabilities after contexts, of symbols that follow ``n`` times and have ``p`` after the
        longest retained suffix."""
        total = self.totals[level][context]
        return np.where(total > 0, (n + smoothing * p) / (total + smoothing), p)


class Counts:
    """Sorted codes and how often each occurs; 0 for others."""

    def __init__(self, blocks: pd.DataFrame):
        """Of rows ``size, codes, n``; codes that come several times are summed up."""
        codes = [np.cumsum(unpack(c, s)) for c, s in zip(blocks["codes"], blocks["size"], strict=True)]
        n = [unpack(c, s) for c, s in zip(blocks["n"], blocks["size"], strict=True)]
        self.codes, self.n = (np.concatenate([np.empty(0, np.int64), *x]) for x in (codes, n))
        if len(codes) > 1:
            order = np.argsort(self.codes, kind="stable")
            codes, n = self.codes[order], self.n[order]
            first = np.flatnonzero(np.diff(codes, prepend=-1))
            self.codes, self.n = codes[first], np.add.reduceat(n, first)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        inside, at = found(self.codes, wanted)
        return np.where(inside, self.n[at], 0) if len(self.n) else at


#: A block's share of what was counted, of what a chunk asks for, or of the sum.
BLOCKS = "block int, chunk long, level int, size int, codes binary, n binary"


def _texts(raw: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of texts one behind the other, where in its text each is, and where texts begin."""
    texts = [np.frombuffer(r, kind) for r in raw]
    sizes = np.array([len(x) for x in texts])
    begin = np.cumsum(sizes) - sizes
    return np.concatenate(texts).astype(np.int64), np.arange(sizes.sum()) - np.repeat(begin, sizes), begin


def asked(rows: DataFrame, contexts: Contexts, kind: str, blocks: int, levels: list[int]) -> DataFrame:
    """Codes of ``rows (chunk, symbols)`` and how often they occur, by block, chunk and level. Tasks
    combine what they count before it is moved."""
    shared = rows.sparkSession.sparkContext.broadcast(contexts)

    def ask(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c: Contexts = shared.value
        held: list[bytes] = []
        chunk = size = 0

        def flush() -> Iterator[pd.DataFrame]:
            if not held:
                return
            x, place, _ = _texts(held, kind)
            for level, (_, codes) in enumerate(c.places(x, place), 1):
                if level not in levels or not len(codes):
                    continue
                codes, n = np.unique(codes, return_counts=True)
                block = c.block(level, codes, blocks)
                order = np.argsort(block.astype(np.min_scalar_type(blocks)), kind="stable")
                block, first = np.unique(block[order], return_index=True)
                codes, n = (np.split(v[order], first[1:]) for v in (codes, n))
                yield pd.DataFrame({
                    "block": block.astype(np.int32), "chunk": chunk, "level": np.int32(level),
                    "size": np.array([len(v) for v in codes], np.int32),
                    "codes": [pack(np.diff(v, prepend=0)) for v in codes], "n": [pack(v) for v in n],
                })
            held.clear()

        for part in parts:
            for at, raw in zip(part["chunk"], part["symbols"], strict=True):
                if at != chunk or size >= 2 * CHUNK:
                    yield from flush()
                    chunk, size = at, 0
                held.append(raw)
                size += len(raw) // int(kind[-1])
        yield from flush()

    return rows.select("chunk", "symbols").mapInPandas(ask, BLOCKS)


class Tree:
    """The counted contexts and, as stored tables, what follows them and which are retained.

    ``counts`` has a row for each block and level: codes and how often they occur. ``contexts (level,
    context, total)`` are the retained ones.
    """

    def __init__(self, known: Contexts, kind: str, blocks: int, counts: DataFrame, contexts: DataFrame, smoothing: float):
        self.known, self.kind, self.blocks, self.smoothing = known, kind, blocks, smoothing
        self.counts, self.contexts = counts, contexts


def grow(
    symbols: DataFrame,
    alphabet: Alphabet,
    depth: int = DEPTH,
    least: int = LEAST,
    divergence: float = DIVERGENCE,
    smoothing: float = SMOOTHING,
    blocks: int | None = None,
) -> Tree:
    """The tree of the training rows' ``symbols``.

    A context that occurs ``least`` times, or more in large collections, is retained if the distribution
    after it diverges from that of its longest retained suffix by ``divergence`` and by more than
    chance. Levels are counted one after the other, as a context occurs no more often than what is left
    without its last symbol.
    """
    blocks = blocks or alphabet.n // BLOCK + 8
    enough, known = frequent(alphabet.n, least), Contexts(alphabet.base)
    levels: list[DataFrame] = []
    retained: list[DataFrame] = []
    total, free = F.col("total"), F.col("free")
    for level in range(1, depth + 1):
        told = asked(symbols, known, alphabet.kind, blocks, [level])
        counts = stored(merged(reduce(DataFrame.union, [told, *levels]), known, level, smoothing), "counts")
        stats = divergences(counts).where(total >= enough).select(
            # The sum of share * log(share / parent); chance alone gives half of ``free`` over the count.
            "context", "total", (F.col("gain") / total - F.log(total)).alias("gain"), F.greatest(F.lit(1), F.col("types") - 1).alias("free")
        )
        sure = 2 * total * F.col("gain") >= free + 3 * F.sqrt(2 * free)
        kept = stats.where((F.col("gain") >= divergence) & sure).select(F.lit(level).alias("level"), "context", "total")
        retained.append(stored(kept, "retained"))
        levels.append(counts.select("block", "chunk", "level", "size", "codes", "n"))
        kept = retained[-1].toPandas()  # no more than there are counted contexts
        known.totals[level] = np.zeros(len(known.last[level]), np.int64)
        known.totals[level][kept["context"].to_numpy(np.int64)] = kept["total"].to_numpy(np.int64)
        if level < depth:
            codes = often(counts, enough).toPandas()["code"].to_numpy(np.int64)
            known.add(level + 1, np.sort(codes))
    contexts = reduce(DataFrame.union, retained)
    return Tree(known, alphabet.kind, blocks, reduce(DataFrame.union, levels), contexts, smoothing)


def merged(held: DataFrame, contexts: Contexts, level: int, smoothing: float) -> DataFrame:
    """Per block the sums of its codes of a level, of which ``held`` has what chunks counted beside the
    sums of the levels below. For each context that the block has codes of: the sum of ``n * log(n /
    parent)``, of ``n``, and the number of codes; parent is the probability after the longest retained
    suffix."""
    shared = held.sparkSession.sparkContext.broadcast(contexts)
    schema = f"{BLOCKS}, contexts binary, gain binary, total binary, types binary"

    def merge(held: pd.DataFrame) -> pd.DataFrame:
        c: Contexts = shared.value
        own = Counts(held[held["level"] == level])
        if not len(own.codes):
            return pd.DataFrame(columns=[x.split()[0] for x in schema.split(", ")])
        context, following = np.divmod(own.codes, c.k)
        parent, suffixes, number = c.base[following], [], context
        for below in range(level - 1, 0, -1):
            number = c.suffix[below + 1][number]
            suffixes.append((below, number))
        for below, number in reversed(suffixes):
            n = Counts(held[held["level"] == below])(number * c.k + following)
            parent = c.smoothed(below, number, n, parent, smoothing)
        first = np.flatnonzero(np.diff(context, prepend=-1))
        row = {
            "block": held["block"].iloc[0], "chunk": -1, "level": level, "size": len(own.codes),
            "codes": pack(np.diff(own.codes, prepend=0)), "n": pack(own.n), "contexts": pack(context[first]),
            "gain": np.add.reduceat(own.n * np.log(own.n / parent), first).tobytes(),
            "total": pack(np.add.reduceat(own.n, first)), "types": pack(np.diff(first, append=len(context))),
        }
        return pd.DataFrame([row])

    return held.groupBy("block").applyInPandas(merge, schema)


def divergences(counts: DataFrame) -> DataFrame:
    """``context, gain, total, types``: what blocks have of each context, summed up."""

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for c, gain, total, types in zip(*(part[x] for x in ("contexts", "gain", "total", "types")), strict=True):
                size = len(gain) // 8
                yield pd.DataFrame({
                    "context": unpack(c, size), "gain": np.frombuffer(gain), "total": unpack(total, size),
                    "types": unpack(types, size),
                })

    told = counts.select("contexts", "gain", "total", "types")
    told = told.mapInPandas(rows, "context long, gain double, total long, types long")
    return told.groupBy("context").agg(*(F.sum(x).alias(x) for x in ("gain", "total", "types")))


def often(counts: DataFrame, enough: float) -> DataFrame:
    """The codes that occur ``enough`` times."""

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for i in range(len(part)):
                block = Counts(part.iloc[i : i + 1])
                yield pd.DataFrame({"code": block.codes[block.n >= enough]})

    return counts.select("size", "codes", "n").mapInPandas(rows, "code long")


def gains(raw: list[bytes], counts: dict[int, Counts], c: Contexts, kind: str, smoothing: float) -> np.ndarray:
    """For each text, the logarithm of its symbols' probabilities after their longest retained
    contexts, over the base's."""
    x, place, begin = _texts(raw, kind)
    p = c.base[x]
    for level, (at, codes) in enumerate(c.places(x, place), 1):
        context = codes // c.k
        inside = np.flatnonzero(c.totals[level][context])
        at = at[inside]
        p[at] = c.smoothed(level, context[inside], counts[level](codes[inside]), p[at], smoothing)
    return np.add.reduceat(np.log10(p / c.base[x]), begin)


def _by_level(blocks: pd.DataFrame, c: Contexts) -> dict[int, Counts]:
    return {level: Counts(blocks[blocks["level"] == level]) for level in c.last}


def gains_by_table(rows: DataFrame, tree: Tree) -> DataFrame:
    """``row, gain`` of ``rows (row, symbols)``, by a broadcast of a tree that is known to be small."""
    counts = _by_level(tree.counts.select("level", "size", "codes", "n").toPandas(), tree.known)
    shared = rows.sparkSession.sparkContext.broadcast((counts, tree.known))
    kind, smoothing = tree.kind, tree.smoothing

    @F.pandas_udf("double")
    def gained(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts, known = shared.value
        for part in parts:
            out, texts, size = [], [], 0
            for raw in part:
                texts.append(raw)
                size += len(raw) // int(kind[-1])
                if size >= TOGETHER:
                    out.append(gains(texts, counts, known, kind, smoothing))
                    texts, size = [], 0
            if texts:
                out.append(gains(texts, counts, known, kind, smoothing))
            yield pd.Series(np.concatenate(out) if out else [], dtype="float64")

    return rows.select("row", gained("symbols").alias("gain"))


def gains_by_blocks(rows: DataFrame, tree: Tree) -> DataFrame:
    """The same for ``rows (row, chunk, symbols)`` and a tree of any size: each chunk's different codes
    go to their blocks once, and their counts come back to the chunk."""
    spark, kind, smoothing = rows.sparkSession, tree.kind, tree.smoothing
    shared = spark.sparkContext.broadcast(tree.known)
    told = asked(rows, tree.known, kind, tree.blocks, sorted(tree.known.last))

    def answer(held: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, same in held.groupby("level"):
            counts = Counts(same[same["chunk"] < 0])
            for ask in same[same["chunk"] >= 0].itertuples():
                codes = np.cumsum(unpack(ask.codes, ask.size))
                n = counts(codes)
                codes, n = codes[n > 0], n[n > 0]
                if len(n):
                    out.append((ask.chunk, ask.level, len(n), pack(np.diff(codes, prepend=0)), pack(n)))
        return pd.DataFrame(out, columns=["chunk", "level", "size", "codes", "n"])

    answers = told.union(tree.counts).groupBy("block").applyInPandas(answer, "chunk long, level int, size int, codes binary, n binary")

    def gained(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        known, out = shared.value, []
        counts = _by_level(answers, known)
        ends = np.cumsum(texts["symbols"].map(len).to_numpy()) // (int(kind[-1]) * TOGETHER)
        for _, some in texts.groupby(ends):
            out.append(pd.DataFrame({"row": some["row"], "gain": gains(some["symbols"].tolist(), counts, known, kind, smoothing)}))
        return pd.concat(out) if out else pd.DataFrame({"row": [], "gain": []})

    texts = rows.select("chunk", "row", "symbols").groupBy("chunk")
    return texts.cogroup(answers.groupBy("chunk")).applyInPandas(gained, "row long, gain double")


def score(docs: DataFrame, held: Column, depth: int = DEPTH, least: int = LEAST, small: int = SMALL) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs``.

    Learns from rows where ``held`` is false. A null text is an empty one: its end alone. Repeated
    rows are scored each, and texts of any length whole. If there is nothing to learn from, every
    score is the base's. An empty table gives an empty one. Other columns are not looked at. The tree
    grows with the training texts; up to ``small`` entries it is broadcast, beyond them asked by blocks.
    """
    docs = docs.select("doc_id", "text")
    vocab = stored(vocabulary(docs.where(~held)), "vocabulary")
    alphabet = Alphabet(vocab)
    rows = stored(encoded(docs, alphabet, ~held), "symbols")
    tokens = rows.agg(F.sum("n_tokens")).first()[0] or 0
    tree = grow(rows.where("train"), alphabet, depth, least, blocks=tokens // BLOCK + 8)
    size = tree.counts.agg(F.sum("size")).first()[0] or 0
    by = gains_by_table if size <= small else gains_by_blocks
    gained = stored(by(rows.select("row", "chunk", "symbols"), tree), "gains")

    rare = rows.select("row", F.explode("rare").alias("hash")).join(vocab.select("hash", "count"), "hash")
    rare = rare.groupBy("row").agg(
        F.count("*").alias("n_rare"), F.sum(F.log10(F.col("count") + 1)).alias("rare_sum")
    )
    scored = rows.select(
        "row", "doc_id", "train", "n_tokens", "n_common", "common_sum"
    ).join(rare, "row", "left").join(gained, "row", "left")
    base = (
        F.col("common_sum")
        + F.coalesce("rare_sum", F.lit(0.0))
        - F.col("n_tokens") * F.log10(F.lit(float(alphabet.n + alphabet.v + 1)))
    )
    return scored.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        (F.col("n_common") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(alphabet.n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (base + F.coalesce("gain", F.lit(0.0))).alias("score"),
    )
