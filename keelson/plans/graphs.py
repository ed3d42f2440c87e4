"""A purchase graph in ragged adjacency lines: who bought which part.

Customers are the even vertices and parts the odd ones, so the two never meet. Each line item is
one line of its customer; some lines repeat the part, hold double blanks, or end in a blank.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators.graph import (
    adjacency,
    bfs_distances,
    degrees,
    degrees_of_separation,
    edges,
    level_stats,
    symmetric,
)
from keelson.operators.ranking import attach_name, bottom_ties, top_k
from keelson.plans.registry import query
from keelson.sources import parse_adjacency, table

START, TARGET, HOPS = 0, 29, 10
# Narrow enough here for busy customers to have several rows.
WIDTH = 16

PAIRS_SQL = """
    SELECT 2 * o_custkey AS src, 2 * l_partkey + 1 AS dst, l_returnflag AS flag, l_quantity AS quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
EDGES_SQL = f"""
    pairs AS ({PAIRS_SQL}),
    edges AS (SELECT src, dst FROM pairs WHERE {{where}} UNION SELECT dst, src FROM pairs WHERE {{where}})
"""
# Deeper than any of these graphs: SQL ends there, the search by itself.
DEEPEST = 60
BFS_SQL = """
    WITH RECURSIVE {edges},
    walk(id, d) AS (
        SELECT CAST({start} AS BIGINT), 0
        UNION SELECT e.dst, w.d + 1 FROM walk w JOIN edges e ON e.src = w.id WHERE w.d < {deepest}),
    found AS (SELECT id, min(d) AS distance FROM walk GROUP BY id)
"""


def purchases(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        (2 * F.col("o_custkey")).alias("src"),
        (2 * F.col("l_partkey") + 1).alias("dst"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_quantity").alias("quantity"),
    )


def adjacency_lines(spark, folder):
    rest = F.when(F.col("flag") == "R", F.concat(F.lit("  "), "dst", F.lit(" "), "dst"))
    rest = rest.when(F.col("flag") == "A", F.concat(F.lit(" "), "dst", F.lit(" ")))
    rest = rest.otherwise(F.concat(F.lit(" "), "dst"))
    return purchases(spark, folder).select(F.concat("src", rest).alias("value"))


def purchase_edges(spark, folder, where="true"):
    """One edge each way per line item: a part bought twice is two edges."""
    return symmetric(purchases(spark, folder).where(where))


@query(f"""
    SELECT src AS id, CASE WHEN flag = 'R' THEN dst || ',' || dst ELSE CAST(dst AS VARCHAR) END AS connections,
           CASE WHEN flag = 'R' THEN 2 ELSE 1 END AS n
    FROM ({PAIRS_SQL})
""")
def adjacency_parse(spark, folder):
    parsed = parse_adjacency(adjacency_lines(spark, folder))
    return parsed.select(
        "id",
        F.concat_ws(",", F.col("connections").cast("array<string>")).alias("connections"),
        F.size("connections").alias("n"),
    )


DEGREES_SQL = f"""
    SELECT src AS id, CAST(sum(CASE WHEN flag = 'R' THEN 2 ELSE 1 END) AS BIGINT) AS degree
    FROM ({PAIRS_SQL}) GROUP BY src
"""


@query(DEGREES_SQL)
def vertex_degrees(spark, folder):
    return degrees(parse_adjacency(adjacency_lines(spark, folder)))


@query(f"SELECT src AS id, count(DISTINCT dst) AS degree FROM ({PAIRS_SQL}) GROUP BY src")
def vertex_degrees_distinct(spark, folder):
    return degrees(parse_adjacency(adjacency_lines(spark, folder)), distinct=True)


def _customer_names(spark, folder):
    return table(spark, folder, "customer").select((2 * F.col("c_custkey")).alias("id"), F.col("c_name").alias("name"))


@query(f"""
    SELECT id, degree, c_name AS name FROM
      (SELECT * FROM ({DEGREES_SQL}) ORDER BY degree DESC, id LIMIT 1)
    LEFT JOIN customer ON id = 2 * c_custkey
""")
def most_connected(spark, folder):
    best = top_k(degrees(parse_adjacency(adjacency_lines(spark, folder))), ["-degree", "id"], 1)
    return attach_name(best, _customer_names(spark, folder), "id", few=1)


@query(f"""
    WITH degrees AS ({DEGREES_SQL})
    SELECT id, degree, c_name AS name FROM degrees LEFT JOIN customer ON id = 2 * c_custkey
    WHERE degree = (SELECT min(degree) FROM degrees)
""")
def least_connected(spark, folder):
    least = bottom_ties(degrees(parse_adjacency(adjacency_lines(spark, folder))), "degree")
    return attach_name(least, _customer_names(spark, folder), "id")


SETS_SQL = f"""
    SELECT src AS id, (nth - 1) // {WIDTH} AS chunk, list(dst ORDER BY dst) AS connections
    FROM (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) AS nth
          FROM (SELECT DISTINCT src, dst FROM ({PAIRS_SQL}))) GROUP BY ALL
"""


@query(f"SELECT id, chunk, array_to_string(connections, ',') AS connections FROM ({SETS_SQL})")
def adjacency_sets(spark, folder):
    sets = adjacency(edges(parse_adjacency(adjacency_lines(spark, folder))), WIDTH)
    joined = F.concat_ws(",", F.col("connections").cast("array<string>"))
    return sets.select("id", "chunk", joined.alias("connections"))


@query(f"SELECT id, len(connections) AS n FROM ({SETS_SQL}) WHERE list_contains(connections, {TARGET})")
def lists_target(spark, folder):
    """The vertices whose adjacency rows list one vertex."""
    sets = adjacency(edges(parse_adjacency(adjacency_lines(spark, folder))), WIDTH)
    return sets.where(F.array_contains("connections", F.lit(TARGET).cast("bigint"))).select(
        "id", F.size("connections").cast("bigint").alias("n")
    )


@query(BFS_SQL.format(edges=EDGES_SQL.format(where="true"), start=START, deepest=DEEPEST) + "SELECT id, distance FROM found")
def bfs_levels(spark, folder):
    return bfs_distances(purchase_edges(spark, folder), START, undirected=True)


@query(BFS_SQL.format(edges=EDGES_SQL.format(where="quantity >= 48"), start=START, deepest=DEEPEST)
       + "SELECT id, distance FROM found")
def bfs_levels_bulk(spark, folder):
    """On the sparse graph of large purchases, which is deeper."""
    return bfs_distances(purchase_edges(spark, folder, "quantity >= 48"), START, undirected=True)


@query(BFS_SQL.format(edges=EDGES_SQL.format(where="true"), start=START, deepest=DEEPEST) + """
    SELECT distance, count(*) AS vertices, CAST(coalesce(sum(n), 0) AS BIGINT) AS edges
    FROM found LEFT JOIN (SELECT src, count(*) AS n FROM edges GROUP BY src) ON src = id GROUP BY distance
""")
def bfs_level_stats(spark, folder):
    return level_stats(purchase_edges(spark, folder), START, undirected=True)


@query(BFS_SQL.format(edges=EDGES_SQL.format(where="true"), start=START, deepest=HOPS) + f"""
    SELECT {START} AS start, {TARGET} AS target, t.distance AS degrees,
           (SELECT count(*) FROM edges e JOIN found f ON f.id = e.src
            WHERE e.dst = {TARGET} AND f.distance = t.distance - 1) AS hits,
           (SELECT count(*) FROM pairs p JOIN found f ON f.id = p.src
            WHERE p.dst = {TARGET} AND f.distance = t.distance - 1) AS hit_edges,
           CASE WHEN t.distance IS NOT NULL THEN true
                WHEN (SELECT max(distance) FROM found) < {HOPS} THEN false END AS reachable
    FROM (SELECT min(distance) AS distance FROM found WHERE id = {TARGET}) t
""")
def separation(spark, folder):
    return degrees_of_separation(purchase_edges(spark, folder), START, TARGET, max_depth=HOPS, undirected=True)
