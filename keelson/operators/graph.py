"""Vertex degrees, adjacency, and breadth-first distances on edge tables ``(src, dst)``.

A graph is an edge table. A vertex that owns a third of the edges is still spread over many tasks
and rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from keelson.operators.positions import running
from keelson.session import keep, work_dir


def edges(adjacency: DataFrame) -> DataFrame:
    """Distinct edges of ``(id, connections)`` rows, directed as listed."""
    # A plain explode would have the whole array expression evaluated again as a filter on size.
    out = adjacency.select(F.col("id").alias("src"), F.explode_outer("connections").alias("dst"))
    return out.where(F.col("dst").isNotNull()).distinct()


def symmetric(edge_table: DataFrame) -> DataFrame:
    """Each edge and its reverse, from one pass over the input; repeats are kept."""
    return edge_table.select(F.stack(F.lit(2), "src", "dst", "dst", "src").alias("src", "dst"))


def degrees(adjacency: DataFrame, distinct: bool = False) -> DataFrame:
    """Connections listed by each vertex over all of its lines; repeats count unless ``distinct``."""
    if distinct:
        # Vertices without a neighbour keep degree 0.
        ids = adjacency.select(F.col("id"), F.explode_outer("connections").alias("dst")).distinct()
        return ids.groupBy("id").agg(F.count("dst").alias("degree"))
    return adjacency.groupBy("id").agg(F.sum(F.size("connections")).cast("bigint").alias("degree"))


def adjacency(edge_table: DataFrame, width: int = 4096) -> DataFrame:
    """``(id, chunk, connections)`` with the sorted distinct neighbours of each vertex.

    A vertex with at most ``width`` neighbours is one row, chunk 0. Of one with more, chunk ``c``
    holds the neighbours of ranks ``c * width`` up to ``(c + 1) * width``. Only vertices that may be
    that wide are ranked, over ranges, so that a vertex with a third of all edges fills many tasks.
    """
    stored = keep(edge_table.select("src", "dst"), "edges")
    listed = stored.groupBy("src").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > width).select("src")
    wide = keep(listed, "wide-vertices")
    collect = F.sort_array(F.collect_set("dst")).alias("connections")
    narrow = stored.join(wide, "src", "left_anti").groupBy(F.col("src").alias("id")).agg(collect)
    ranked = running(stored.join(wide, "src", "left_semi").distinct(), ["src"], ["dst"], F.lit(1), "rank")
    chunk = F.expr(f"CAST(rank div {int(width)} AS BIGINT)").alias("chunk")
    cut = ranked.groupBy(F.col("src").alias("id"), chunk).agg(collect)
    return narrow.select("id", F.lit(0).cast("bigint").alias("chunk"), "connections").union(cut)


class Search:
    """A breadth-first search over edges that are written once, bucketed, and never move again.

    ``graph (src, salt, dst, n)`` lies in buckets by vertex and salt; ``n`` counts the repeats of an
    edge, loops are left out. A vertex with more than a bucket's fair share of the edges has several
    salts; there are fewer such vertices than buckets, which bounds their broadcast. A level moves
    its frontier to the edges' buckets, and what it finds once more by id to leave out what was
    found before. ``undirected`` says that every edge has its reverse as often: then only the last
    two levels can hold such vertices. Otherwise the levels lie in buckets by id, so that they do
    not move either.

    Each level is one job that writes its new vertices: lineage stays one level deep and a lost
    executor costs at most the running level. The driver sees a count and a flag per level.
    """

    def __init__(
        self, edge_table: DataFrame, start: int | str, undirected: bool = False, edges_of: Search | None = None
    ):
        self.spark, self.undirected = edge_table.sparkSession, undirected
        self.root = work_dir(self.spark, "search")
        self.depth, self.found = 0, 0
        if edges_of is None:
            self._save_edges(edge_table)
        else:
            self.buckets, self.graph = edges_of.buckets, edges_of.graph
            self.hot, self.salted = edges_of.hot, edges_of.salted
        self.id = StructField("id", self.graph.schema["src"].dataType)
        self.table = f"levels_{uuid.uuid4().hex}"
        self._save(self.spark.range(1).select(F.lit(start).cast(self.id.dataType).alias("id")), None)

    def _save_edges(self, edge_table: DataFrame) -> None:
        spark = self.spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        counted = edge_table.where("src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
        counted, total = self._counted_write(counted, "counted")
        share = max(1, total // self.buckets)
        degree = counted.groupBy("src").agg(F.count(F.lit(1)).alias("edges")).where(F.col("edges") > share)
        self.hot, self.salted = self._counted_write(
            degree.select("src", F.ceil(F.col("edges") / share).cast("int").alias("salts")), "hot"
        )
        salted = counted.withColumn("salt", F.lit(0))
        if self.salted:
            salt = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("salts")), F.lit(0)).cast("int")
            salted = counted.join(F.broadcast(self.hot), "src", "left").withColumn("salt", salt)
        salted = salted.select("src", "salt", "dst", "n")
        name = f"edges_{uuid.uuid4().hex}"
        salted.repartition(self.buckets, "src", "salt").write.format("parquet").option(
            "path", f"{self.root}/edges"
        ).bucketBy(self.buckets, "src", "salt").saveAsTable(name)
        self.graph = spark.table(name)
        self.graph.schema  # resolved: from here on the files count and not the name
        spark.sql(f"DROP TABLE {name}")

    def _counted_write(self, rows: DataFrame, name: str) -> tuple[DataFrame, int]:
        """The rows, stored, and their number, from one job."""
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.root}/{name}"), seen.get["n"]

    def _save(self, vertices: DataFrame, wanted: Column | None) -> bool:
        """Append a level; its size and whether it holds what is wanted come from the same job."""
        seen = Observation()
        hit = F.lit(False) if wanted is None else F.coalesce(F.max(wanted), F.lit(False))
        watched = vertices.observe(seen, F.count(F.lit(1)).alias("n"), hit.alias("hit"))
        if self.undirected:
            watched.select("id").write.parquet(f"{self.root}/levels/distance={self.depth}")
        else:
            watched.select("id", F.lit(self.depth).alias("distance")).write.format("parquet").option(
                "path", f"{self.root}/levels"
            ).partitionBy("distance").bucketBy(self.buckets, "id").mode("append").saveAsTable(self.table)
        self.found = seen.get["n"]
        return seen.get["hit"]

    def _levels(self, depths: list[int]) -> DataFrame:
        if not self.undirected:
            return self.spark.table(self.table).where(F.col("distance").isin(depths)).select("id")
        paths = [f"{self.root}/levels/distance={d}" for d in depths]
        return self.spark.read.schema(StructType([self.id])).parquet(*paths)

    def visited(self) -> DataFrame:
        """``id`` of the vertices found, so far as the frontier's neighbours can be among them."""
        if self.undirected:
            return self._levels(list(range(max(0, self.depth - 1), self.depth + 1)))
        return self.spark.table(self.table).select("id")

    def level(self, depth: int) -> DataFrame:
        return self._levels([depth])

    def successors(self, vertices: DataFrame) -> DataFrame:
        """``id``: the vertices that ``vertices (id)`` list, as often as they do."""
        front = vertices.select(F.col("id").alias("src"), F.lit(0).alias("salt"))
        if self.salted:
            salts = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
            front = front.join(F.broadcast(self.hot), "src", "left").select("src", F.explode(salts).alias("salt"))
        return self.graph.join(front, ["src", "salt"], "left_semi").select(F.col("dst").alias("id"))

    def ahead(self) -> DataFrame:
        """``id``: the vertices one hop beyond the frontier."""
        return self.successors(self.level(self.depth)).distinct().join(self.visited(), "id", "left_anti")

    def go(self, target: int | str | None = None, meet: Search | None = None) -> bool:
        """One level on; whether it holds ``target``, or a vertex of the frontier of ``meet``."""
        new = self.ahead()
        self.depth += 1
        if meet is None:
            return self._save(new, None if target is None else F.col("id") == F.lit(target))
        other = meet.level(meet.depth).withColumn("met", F.lit(True))
        return self._save(new.join(other, "id", "left"), F.col("met"))

    def close(self) -> DataFrame:
        """``(id, distance)``, read from the files: the name goes."""
        schema = StructType([self.id, StructField("distance", IntegerType())])
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        return self.spark.read.schema(schema).parquet(f"{self.root}/levels")


def breadth_first(
    edge_table: DataFrame,
    start: int | str,
    max_depth: int | None = None,
    target: int | str | None = None,
    undirected: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The stored edges ``(src, dst, n)`` and ``(id, distance)`` of the vertices reached from ``start``.

    ``n`` counts the repeats of an edge; loops are left out. The search goes on until no new vertex
    is found, or for ``max_depth`` hops if given, or after the level that reaches ``target``, if given.
    ``undirected`` says that every edge has its reverse as often.
    """
    search = Search(edge_table, start, undirected)
    hit = target is not None and start == target
    while search.found and not hit and (max_depth is None or search.depth < max_depth):
        hit = search.go(target)
    return search.graph.select("src", "dst", "n"), search.close()


def bfs_distances(
    edge_table: DataFrame, start: int | str, max_depth: int | None = None, undirected: bool = False
) -> DataFrame:
    """``(id, distance)`` of every vertex that ``start`` reaches, in ``max_depth`` hops if given."""
    return breadth_first(edge_table, start, max_depth, undirected=undirected)[1]


def level_stats(
    edge_table: DataFrame, start: int | str, max_depth: int | None = None, undirected: bool = False
) -> DataFrame:
    """Per level of the search: vertices in the frontier, and distinct edges that leave it."""
    graph, distances = breadth_first(edge_table, start, max_depth, undirected=undirected)
    out_degree = graph.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("edges"))
    return (
        distances.join(out_degree, "id", "left")
        .groupBy("distance")
        .agg(
            F.count(F.lit(1)).alias("vertices"),
            F.coalesce(F.sum("edges"), F.lit(0)).cast("bigint").alias("edges"),
        )
    )


def degrees_of_separation(
    edge_table: DataFrame,
    start: int | str,
    target: int | str,
    max_depth: int | None = 10,
    undirected: bool = False,
) -> DataFrame:
    """One row ``(start, target, degrees, hits, hit_edges, reachable)``.

    ``degrees`` is NULL when the target is not found. ``hits`` counts the vertices one hop before the
    target on a shortest way, ``hit_edges`` their edges to it, repeats included. ``reachable`` is
    false if the search ended by itself without the target, NULL if ``max_depth`` ended it.

    Two searches, from the start and against the edges from the target, take turns, the one with
    the smaller frontier first, until a new level meets the other's frontier: each goes about half
    the way. ``undirected`` says that every edge has its reverse as often, which spares a second
    table of edges.
    """
    ahead = Search(edge_table, start, undirected)
    turned = edge_table.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    back = Search(turned, target, undirected, ahead if undirected else None)
    met = start == target
    hops = lambda: ahead.depth + back.depth
    while not met and ahead.found and back.found and (max_depth is None or hops() < max_depth):
        one, other = (ahead, back) if ahead.found <= back.found else (back, ahead)
        met = one.go(meet=other)
    spark = ahead.spark
    degrees = hops() if met else None
    hits = spark.createDataFrame([], StructType([ahead.id]))
    if met and degrees:
        # The vertices where the searches meet lie on shortest ways; from there on to the target.
        nearest = ahead.level(ahead.depth).join(back.level(back.depth), "id", "left_semi")
        if back.depth == 0:
            nearest = ahead.level(ahead.depth - 1)
        for left in range(back.depth - 1, 0, -1):
            nearest = ahead.successors(nearest).distinct().join(back.level(left), "id", "left_semi")
        hits = nearest
    to_target = ahead.graph.where(F.col("dst") == F.lit(target)).select(F.col("src").alias("id"), "n")
    found = to_target.join(hits, "id").agg(F.count(F.lit(1)).alias("hits"), F.sum("n").alias("hit_edges"))
    reachable = True if met else False if not (ahead.found and back.found) else None
    row = found.select(
        F.lit(start).alias("start"),
        F.lit(target).alias("target"),
        F.lit(degrees).cast("int").alias("degrees"),
        "hits",
        F.coalesce("hit_edges", F.lit(0)).cast("bigint").alias("hit_edges"),
        F.lit(reachable).cast("boolean").alias("reachable"),
    )
    row.write.parquet(f"{ahead.root}/separation")  # before the levels' names go
    ahead.close()
    back.close()
    return spark.read.schema(row.schema).parquet(f"{ahead.root}/separation")
