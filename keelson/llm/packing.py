"""Packing token sequences by Karmarkar-Karp multiway differencing.

Every text becomes token ids and one end id. Each whole window of a document is a sequence of its
own; the rest is cut into pieces of at most ``unit`` ids. Pieces are dealt to groups of bounded
size by a hash, and every group is partitioned into windows on its own: partial partitions with the
largest spread are merged, the fullest window of one with the emptiest of the other, until one is
left. If a window exceeds the capacity, the number of windows rises and the group is done anew.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import stored

#: Tokens whose ids a task holds before it hands them on.
HELD = 1 << 17
#: Pieces of a group on average, and room for the windows of one in a sequence id.
GROUP, ROOM = 2048, 20


def difference(sizes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """``(window of each size, sums)``: a partition into ``count`` windows of nearly equal sums."""
    n = len(sizes)
    # A partial partition: window sums without their minimum, rising, and a tree of pieces for each.
    # Tree nodes 1..n are pieces, later ones join two; 0 is an empty window.
    kids = np.zeros((2 * n + 1, 2), np.int64)
    made = n + 1
    heap: list = []
    for i in np.argsort(-sizes, kind="stable").tolist():
        heap.append((-int(sizes[i]), i, int(sizes[i]), i + 1))
    heapq.heapify(heap)

    def whole(entry):
        sums, trees = entry[2], entry[3]
        if isinstance(sums, int):
            out, tree = np.zeros(count, np.int64), np.zeros(count, np.int64)
            out[-1], tree[-1] = sums, trees
            return out, tree
        return sums, trees

    serial = n
    while len(heap) > 1:
        a, at = whole(heapq.heappop(heap))
        b, bt = whole(heap[0])
        sums, bt = a + b[::-1], bt[::-1]
        both = np.flatnonzero((at > 0) & (bt > 0))
        trees = at + bt
        ids = np.arange(made, made + len(both))
        kids[ids, 0], kids[ids, 1] = at[both], bt[both]
        trees[both] = ids
        made += len(both)
        order = np.argsort(sums, kind="stable")
        sums, trees = sums[order], trees[order]
        sums = sums - sums[0]
        heapq.heapreplace(heap, (-int(sums[-1]), serial, sums, trees))
        serial += 1
    window = np.zeros(n, np.int64)
    for w, tree in enumerate(whole(heap[0])[1].tolist() if heap else []):
        stack = [tree] if tree else []
        while stack:
            node = stack.pop()
            if node <= n:
                window[node - 1] = w
            else:
                stack += kids[node].tolist()
    return window, np.bincount(window, weights=sizes, minlength=count).astype(np.int64)


def windows_of(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each size, no window over ``capacity``."""
    total = int(sizes.sum())
    count = -(-total // capacity)
    while True:
        window, sums = difference(sizes, count)
        if not len(sums) or sums.max() <= capacity:
            return window
        spread = int(sums.max()) - total // count
        count = max(count + 1, -(-total // max(1, capacity - spread)) if 2 * spread < capacity else count + 1)


class Ids:
    """Token ids of texts by a byte-level BPE vocabulary, made once in a Python worker.

    ``ranks`` is a file of ranks, ``pattern`` splits the text; ``full`` is the same vocabulary as a
    tokenizer file. It names the added tokens, whose strings in a text are one id each, and serves
    the rare text whose splitting the faster library gives up.
    """

    _made: dict = {}

    def __new__(cls, ranks: str, pattern: str, full: str):
        if (ranks, full) not in cls._made:
            cls._made[ranks, full] = made = super().__new__(cls)
            import base64
            import json

            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            with open(full, encoding="utf-8") as file:
                added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
            made.fast = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=table, special_tokens=added)
            made.full, made.slow = full, None
        return cls._made[ranks, full]

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except (KeyboardInterrupt, SystemExit, MemoryError):
            raise
        except BaseException:  # a library's panic is no Exception
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.full)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def tokenizer_files() -> tuple[str, str, str]:
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        public_tokenizers.path("byte_bpe_50k.json"),
    )


def pieces(
    docs: DataFrame, capacity: int = 1024, unit: int = 256, files: tuple | None = None, end: int = 0, ids: bool = False
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, salt`` and, if asked for, the ``ids`` of each piece."""
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, salt long"

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt", *(["ids"] if ids else [])]

    def frame(rows: list) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        if kind == "bigint":
            out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, salt = Ids(*(files or tokenizer_files())), 0
        for part in parts:
            rows, size = [], 0
            for doc, text in zip(part["doc_id"], part["text"], strict=True):
                tokens = np.append(encode(text or ""), end).astype("<u4")
                n = len(tokens)
                full = n - n % capacity
                bounds = [*range(0, full, capacity), *range(full, n, unit), n]
                for a, b in zip(bounds, bounds[1:], strict=False):
                    held = tokens[a:b]
                    rows.append((doc, a, b - a, zlib.crc32(held.tobytes()), n, salt, *([held.astype("<i4")] if ids else [])))
                    salt += 1
                size += n
                if ids and size >= HELD:
                    yield frame(rows)
                    rows, size = [], 0
            yield frame(rows)

    return docs.select("doc_id", "text").mapInPandas(cut, schema + (", ids array<int>" if ids else ""))


def pack(
    docs: DataFrame, capacity: int = 1024, unit: int = 256, files: tuple | None = None, end: int = 0, ids: bool = False
) -> DataFrame:
    """A row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``
    (and ``ids``), every id of ``docs (doc_id, text)`` in just one piece.

    A null or empty text is its end id alone. Texts of any length are cut, never dropped. Repeated
    rows are packed each; a null id stays null. Other columns are not looked at; an empty table gives
    an empty one.
    """
    cuts = stored(pieces(docs, capacity, unit, files, end, ids), "pieces")
    groups = max(1, -(-cuts.count() // GROUP))
    dealt = cuts.withColumn(
        "lot", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "salt"), F.lit(groups)).cast("long")
    ).drop("salt")
    names = [c for c in dealt.columns if c not in ("lot", "sequence_id", "offset")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.select(*names).schema)

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        lot = int(group["lot"].iloc[0])
        group = group.sort_values(["doc_id", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        sizes = group["length"].to_numpy(np.int64)
        window = np.zeros(len(sizes), np.int64)
        whole, rest = np.flatnonzero(sizes >= capacity), np.flatnonzero(sizes < capacity)
        window[rest] = windows_of(sizes[rest], capacity)
        window[whole] = (window[rest].max() + 1 if len(rest) else 0) + np.arange(len(whole))
        order = np.argsort(window, kind="stable")
        ends = np.cumsum(sizes[order])
        starts = ends - sizes[order]
        first = np.r_[True, window[order][1:] != window[order][:-1]]
        offset = np.zeros(len(sizes), np.int64)
        offset[order] = starts - np.maximum.accumulate(np.where(first, starts, 0))
        return group[names].assign(sequence_id=(lot << ROOM) + window, offset=offset)

    return dealt.groupBy("lot").applyInPandas(fill, f"{schema}, sequence_id long, offset long")
