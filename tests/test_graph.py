import random
import re
from collections import deque

import pytest

from keelson.operators import graph


def edge_table(spark, pairs):
    return spark.createDataFrame(pairs, "src bigint, dst bigint")


def walk(pairs, start, depth):
    out, seen, queue = {}, {start: 0}, deque([start])
    for a, b in pairs:
        out.setdefault(a, set()).add(b)
    while queue:
        v = queue.popleft()
        if seen[v] < depth:
            for w in out.get(v, ()):
                if w not in seen:
                    seen[w] = seen[v] + 1
                    queue.append(w)
    return seen


@pytest.fixture(scope="module")
def random_pairs():
    rng = random.Random(3)
    # Vertex 0 lists a third of all edges, and some edges repeat or loop.
    pairs = [(0 if rng.random() < 1 / 3 else rng.randrange(300), rng.randrange(300)) for _ in range(450)]
    return pairs + pairs[:20] + [(5, 5)]


@pytest.mark.parametrize("start, depth", [(0, 10), (17, 3), (999, 4)])
def test_distances(spark, random_pairs, start, depth):
    got = {r.id: r.distance for r in graph.bfs_distances(edge_table(spark, random_pairs), start, depth).collect()}
    assert got == walk(random_pairs, start, depth)


def test_distances_differ_by_one_along_an_edge(spark, random_pairs):
    both = graph.symmetric(edge_table(spark, random_pairs))
    distance = {r.id: r.distance for r in graph.bfs_distances(both, 0, 50).collect()}
    for a, b in random_pairs:
        if a in distance:
            assert abs(distance[a] - distance[b]) <= 1


def test_separation(spark):
    table = edge_table(spark, [(1, 2), (1, 3), (2, 4), (3, 4), (3, 4), (4, 5), (5, 6), (7, 1)])

    def row(start, target, depth=10):
        return tuple(graph.degrees_of_separation(table, start, target, depth).first())

    assert row(1, 4) == (1, 4, 2, 2, 3, True)  # two vertices list it, over three edges
    assert row(1, 2) == (1, 2, 1, 1, 1, True)
    assert row(1, 7) == (1, 7, None, 0, 0, False)  # directed: 7 lists 1, not the reverse
    assert row(1, 1) == (1, 1, 0, 0, 0, True)
    assert row(1, 6, depth=4) == (1, 6, 4, 1, 1, True)
    assert row(1, 6, depth=3) == (1, 6, None, 0, 0, None)


def test_search_stops_at_the_target(spark):
    table = edge_table(spark, [(i, i + 1) for i in range(8)])
    _, found = graph.breadth_first(table, 0, 10, target=2)
    assert max(r.distance for r in found.collect()) == 2


def test_level_stats(spark):
    table = edge_table(spark, [(1, 2), (1, 3), (2, 4), (3, 4)])
    stats = graph.level_stats(table, 1)
    assert sorted(tuple(r) for r in stats.collect()) == [(0, 1, 2), (1, 2, 2), (2, 1, 0)]


def test_degrees_add_up_over_lines(spark):
    lines = spark.createDataFrame([(1, [2, 2, 3]), (1, [4]), (5, [])], "id bigint, connections array<bigint>")
    assert {r.id: r.degree for r in graph.degrees(lines).collect()} == {1: 4, 5: 0}
    assert {r.id: r.degree for r in graph.degrees(lines, distinct=True).collect()} == {1: 3, 5: 0}


def test_adjacency_splits_wide_vertices(spark):
    far = 2**62
    pairs = [(0, i * far // 1000) for i in range(1, 1001)] + [(0, 3 * far // 1000), (1, 2), (1, far), (1, 0), (1, far - 1)]
    pairs += [(2, 7)] * 60  # many repeats of one neighbour are still one row
    rows = graph.adjacency(edge_table(spark, pairs), width=50).collect()
    assert [(r.chunk, r.connections) for r in rows if r.id == 1] == [(0, [0, 2, far - 1, far])]
    assert [(r.chunk, r.connections) for r in rows if r.id == 2] == [(0, [7])]
    hot = {r.chunk: r.connections for r in rows if r.id == 0}
    assert hot == {c: [i * far // 1000 for i in range(50 * c + 1, 50 * c + 51)] for c in range(20)}


def exchanges(plan):
    """The columns that each exchange of a plan deals by."""
    return sorted(re.findall(r"Exchange hashpartitioning\((\w+)#", plan))


def test_no_level_moves_the_edges(spark, random_pairs):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        search = graph.Search(edge_table(spark, random_pairs), 0)
        assert search.hot.count()  # the vertex with a third of the edges has several salts
        for _ in range(3):
            plan = search.ahead()._jdf.queryExecution().executedPlan().toString()
            # The frontier goes to the edges, what it finds to the ids; scans of tables stay in place.
            assert exchanges(plan) == ["id", "src"], plan
            assert plan.count("SortMergeJoin") == 2
            search.go()
        search.close()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("undirected", [False, True])
def test_separation_from_both_ends(spark, random_pairs, undirected):
    pairs = random_pairs + [(b, a) for a, b in random_pairs] if undirected else random_pairs
    table = edge_table(spark, pairs)
    for start, target in [(0, 17), (17, 0), (8, 90)]:
        distance = walk(pairs, start, 99)
        degrees = distance.get(target)
        before = [a for a, b in pairs if b == target != a and distance.get(a) == (degrees or 0) - 1] if degrees else []
        want = (start, target, degrees, len(set(before)), len(before), degrees is not None)
        assert tuple(graph.degrees_of_separation(table, start, target, 99, undirected).first()) == want


def test_each_search_goes_half_the_way(spark, monkeypatch):
    taken = []
    go = graph.Search.go
    monkeypatch.setattr(graph.Search, "go", lambda self, **how: taken.append(self) or go(self, **how))
    chain = edge_table(spark, [(i, i + 1) for i in range(8)])
    assert graph.degrees_of_separation(chain, 0, 8).first().degrees == 8
    assert sorted(taken.count(x) for x in set(taken)) == [4, 4] or len(taken) == 8


def test_no_limit_unless_given(spark):
    table = edge_table(spark, [(i, i + 1) for i in range(25)])
    assert graph.bfs_distances(table, 0).count() == 26
    assert graph.bfs_distances(table, 0, 10).count() == 11
