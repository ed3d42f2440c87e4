"""Nearest neighbours by inner product: a small-world graph for each shard, results merged.

Different vectors are dealt to shards of bounded size by their norm, to a factor of two, and a hash.
A shard's graph is hierarchical: each vector is on the lowest level, every ``LINKS``-th or so on the
next. On a level its neighbours are a row of a flat array. Vectors get one component more, which
gives all of a shard the same norm; then the largest inner product is the least distance too. As the
norms of a shard are comparable, so is that component, and single precision tells its vectors apart. A search goes down greedily to the
lowest level and there widens to the best ``BEAM`` vectors seen. Searches and insertions run many
at a time in step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import stored

#: Vectors of a shard on average; neighbours of a vector; vectors a search keeps; queries in a block.
SHARD, LINKS, BEAM, BLOCK = 4096, 16, 96, 2048


class Graph:
    """``vectors`` (n, d) of one norm; ``levels``: neighbour rows (n, width), -1 where there is none."""

    def __init__(self, vectors: np.ndarray, levels: list[np.ndarray], top: int):
        self.vectors, self.levels, self.top = vectors, levels, top

    def walk(self, queries: np.ndarray, entry: np.ndarray, level: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``beam`` vectors that each query meets on a level: places (-1: none) and products."""
        links, n, q = self.levels[level], len(self.vectors), len(queries)
        row = np.arange(q)
        place = np.full((q, beam), -1, np.int64)
        near = np.full((q, beam), -np.inf, np.float32)
        open_ = np.zeros((q, beam), bool)
        seen = np.zeros((q, n + 1), bool)  # the last column stands for no neighbour
        seen[:, n] = True
        place[:, 0], near[:, 0], open_[:, 0] = entry, np.einsum("qd,qd->q", queries, self.vectors[entry]), True
        seen[row, entry] = True
        live = row
        while len(live):
            best = np.where(open_[live], near[live], -np.inf).argmax(1)
            some = open_[live, best]
            live, best = live[some], best[some]
            if not len(live):
                break
            open_[live, best] = False
            met = links[place[live, best]]
            met = np.where(seen[live[:, None], met], -1, met)
            seen[live[:, None], met] = True
            close = np.einsum("qkd,qd->qk", self.vectors[met], queries[live])
            close = np.where(met >= 0, close, -np.inf).astype(np.float32)
            both = np.concatenate([near[live], close], 1)
            keep = np.argpartition(-both, beam - 1, axis=1)[:, :beam]
            near[live] = np.take_along_axis(both, keep, 1)
            place[live] = np.take_along_axis(np.concatenate([place[live], met], 1), keep, 1)
            fresh = np.concatenate([open_[live], met >= 0], 1)
            open_[live] = np.take_along_axis(fresh, keep, 1) & (near[live] > -np.inf)
        return np.where(near > -np.inf, place, -1), near

    def search(self, queries: np.ndarray, beam: int, down_to: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Best first, on level ``down_to``."""
        entry = np.full(len(queries), self.top, np.int64)
        for level in range(len(self.levels) - 1, down_to, -1):
            place, near = self.walk(queries, entry, level, 1)
            entry = place[:, 0]
        place, near = self.walk(queries, entry, down_to, beam)
        order = np.argsort(-near, axis=1, kind="stable")
        return np.take_along_axis(place, order, 1), np.take_along_axis(near, order, 1)


def _diverse(vectors: np.ndarray, near: np.ndarray, places: np.ndarray, most: int) -> np.ndarray:
    """Of ``places``, nearest first, those nearer to the new vector than to one chosen before; then the rest."""
    among = vectors[places] @ vectors[places].T
    chosen: list[int] = []
    for i in range(len(places)):
        if not chosen or near[i] > among[i, chosen].max():
            chosen.append(i)
            if len(chosen) == most:
                break
    left = [i for i in range(len(places)) if i not in set(chosen)]
    return places[(chosen + left)[:most]]


def build(vectors: np.ndarray, links: int = LINKS, beam: int = BEAM) -> Graph:
    """The graph of different ``vectors``, which have one norm. Insertion order is the given one."""
    n = len(vectors)
    draw = np.random.default_rng(1).random(n)
    height = np.floor(-np.log(np.maximum(draw, 1e-12)) / np.log(links)).astype(int)
    height[0] = max(height.max(), 0)  # the first vector is on all levels, and the way in
    levels = [np.full((n, 2 * links if level == 0 else links), -1, np.int64) for level in range(height[0] + 1)]
    graph, done = Graph(vectors, levels, 0), 1
    while done < n:
        new = np.arange(done, min(n, done + max(1, min(done, 512))))
        for level in range(int(height[new].max()), -1, -1):
            own = new[height[new] >= level]
            place, near = graph.search(vectors[own], beam, level)
            # Those that are inserted at once see each other as well.
            inner = vectors[own] @ vectors[own].T
            np.fill_diagonal(inner, -np.inf)
            place = np.concatenate([place, np.broadcast_to(own, inner.shape)], 1)
            near = np.concatenate([np.where(place[:, : near.shape[1]] >= 0, near, -np.inf), inner], 1)
            order = np.argsort(-near, axis=1, kind="stable")[:, :beam]
            arc: dict[int, list[int]] = {}
            for i, at in enumerate(own.tolist()):
                kept = order[i][near[i, order[i]] > -np.inf]
                chosen = _diverse(vectors, near[i, kept], place[i, kept], links)
                levels[level][at, : len(chosen)] = chosen
                for other in chosen.tolist():
                    arc.setdefault(other, []).append(at)
            for other, more in arc.items():  # links back, thinned where they are too many
                had = levels[level][other]
                every = np.unique(np.r_[had[had >= 0], more])
                if len(every) > len(had):
                    close = vectors[every] @ vectors[other]
                    order_ = np.argsort(-close, kind="stable")
                    every = _diverse(vectors, close[order_], every[order_], len(had))
                levels[level][other] = -1
                levels[level][other, : len(every)] = every
        done = int(new[-1]) + 1
    return graph


def pack(graph: Graph) -> dict:
    return {"height": len(graph.levels), "links": b"".join(x.astype("<i4").tobytes() for x in graph.levels)}


def unpack(vectors: np.ndarray, height: int, links: bytes, width: int = LINKS) -> Graph:
    flat, n, levels, at = np.frombuffer(links, "<i4").astype(np.int64), len(vectors), [], 0
    for level in range(height):
        size = n * (2 * width if level == 0 else width)
        levels.append(flat[at : at + size].reshape(n, -1))
        at += size
    return Graph(vectors, levels, 0)


def one_norm(vectors: np.ndarray) -> np.ndarray:
    """The vectors in a common unit with a component more, so that all have the largest norm."""
    scaled = vectors / np.abs(vectors).max()
    squares = (scaled**2).sum(1)
    return np.c_[scaled, np.sqrt(np.maximum(squares.max() - squares, 0))].astype(np.float32)


def norm_band(vector: str) -> Column:
    """The binary logarithm of the norm, rounded. No square leaves the range of a double."""
    most = F.array_max(F.transform(vector, F.abs))
    share = F.aggregate(F.transform(vector, lambda x: (x / most) * (x / most)), F.lit(0.0), lambda a, x: a + x)
    return F.round(F.log2(most) + F.log2(share) / 2).cast("int")


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the rows that can take part: not null, not zero, all components finite."""
    v = F.col(column).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return vectors.where(F.col("vec_id").isNotNull() & F.col(column).isNotNull() & ~bad & some).select(
        "vec_id", v.alias("vector")
    ).distinct()


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, shard: int = SHARD, beam: int = BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the largest inner product for each query.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; a query's own id is no candidate.
    Equal vectors are one vertex of a graph: of their ids the ``k + 1`` smallest can be among the
    nearest, and are kept. Ties go to the smaller id. Rows with a null id or an unusable vector take
    no part; vectors of different lengths are apart; wholly repeated rows are one. An id with several
    vectors asks with each of them and reports the best. An empty table gives an empty one. Other
    columns are not looked at.
    """
    rows = stored(usable(vectors), "vectors")
    first = Window.partitionBy("vector").orderBy("vec_id")
    held = rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k + 1)
    points = held.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    dims = F.size("vector").alias("dims")
    points = points.select(dims, norm_band("vector").alias("band"), F.xxhash64("vector").alias("place"), "vector", "ids")
    points = stored(points, "points")
    queries = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-queries.count() // BLOCK))
    # A band of norms has shards of its own, numbered after those of smaller norms: a row for each band.
    bands = points.groupBy("dims", "band").agg(F.ceil(F.count("*") / shard).cast("int").alias("own"))
    below = Window.partitionBy("dims").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = stored(bands.withColumn("base", F.coalesce(F.sum("own").over(below), F.lit(0))), "bands")
    number = (F.col("base") + F.pmod("place", F.col("own"))).cast("int").alias("shard")
    dealt = points.join(bands, ["dims", "band"]).select("dims", number, "place", "vector", "ids")

    def index(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place", kind="stable")
        exact = np.array(group["vector"].tolist(), np.float64)
        graph = build(one_norm(exact), beam=beam)
        packed = pack(graph)
        return pd.DataFrame(
            {
                "dims": group["dims"].iloc[:1].to_numpy(),
                "shard": group["shard"].iloc[:1].to_numpy(),
                "vectors": [exact.tobytes()],
                "ids": [np.concatenate(group["ids"].tolist()).astype(np.int64)],
                "counts": [group["ids"].map(len).to_numpy(np.int32)],
                "height": [packed["height"]],
                "links": [packed["links"]],
            }
        )

    graphs = dealt.groupBy("dims", "shard").applyInPandas(
        index,
        "dims int, shard int, vectors binary, ids array<long>, counts array<int>, height int, links binary",
    )
    graphs = stored(graphs, "graphs")

    def find(graph: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(graph) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64").astype({"score": float})
        row = graph.iloc[0]
        exact = np.frombuffer(row["vectors"], np.float64).reshape(-1, int(row["dims"]))
        ids, counts = np.asarray(row["ids"], np.int64), np.asarray(row["counts"], np.int64)
        begin = np.cumsum(counts) - counts
        searcher = unpack(one_norm(exact), int(row["height"]), row["links"])
        out = []
        names = asked["vec_id"].to_numpy(np.int64)
        wanted = np.array(asked["vector"].tolist(), np.float64)
        for at in range(0, len(names), 256):
            part = wanted[at : at + 256]
            unit = part / np.abs(part).max(1, keepdims=True)
            place, _ = searcher.search(np.c_[unit, np.zeros(len(part))].astype(np.float32), beam)
            for name, q, found in zip(names[at : at + 256].tolist(), part, place, strict=True):
                found = found[found >= 0]
                score = np.einsum("nd,d->n", exact[found], q)
                one = np.concatenate([ids[begin[i] : begin[i] + counts[i]] for i in found.tolist()])
                value = np.repeat(score, counts[found])
                one, value = one[one != name], value[one != name]
                best = np.lexsort((one, -value))[:k]
                out.append(pd.DataFrame({"query_id": name, "vec_id": one[best], "score": value[best]}))
        return pd.concat(out, ignore_index=True)

    # Every block of queries meets every shard, once: blocks and shards name the pair.
    block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int").alias("block")
    totals = bands.groupBy("dims").agg(F.sum("own").cast("int").alias("shards"))
    to_shards = queries.select(dims, "vec_id", "vector", block).join(totals, "dims")
    to_shards = to_shards.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("shards")
    to_blocks = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dims", "shard", "block"]
    found = to_blocks.groupBy(*keys).cogroup(to_shards.groupBy(*keys)).applyInPandas(
        find, "query_id long, vec_id long, score double"
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
