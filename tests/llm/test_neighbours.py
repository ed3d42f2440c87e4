import numpy as np
import pytest

from keelson.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int, vector string, place int, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, 2) for i, v in rows], SCHEMA)


def brute(rows, k=20, every=20):
    out = []
    for q, v in rows:
        if q % every == 0:
            near = sorted((-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in rows if i != q and len(w) == len(v))
            out += [(q, r + 1, i) for r, (_, i) in enumerate(near[:k])]
    return sorted(out)


def test_unusable_vectors_ties_and_few_candidates(spark):
    good = [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(1).integers(-3, 4, (15, 4)) + 0.5)]
    good += [(20 + i, [1.5, 0.5, 2.5, 0.5]) for i in range(30)]  # copies: ties go to the smaller id
    bad = [(60, None), (80, [0.0] * 4), (81, [1.0, None, 1.0, 1.0]), (82, [float("nan")] * 4), (100, [float("inf")] * 4),
           (None, [1.0] * 4), (120, [])]
    other = [(200, [1.0, 2.0]), (201, [2.0, 1.0])]
    found = neighbours.nearest(frame(spark, good + bad + other + good[:2]))
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found.collect()) == brute(good + other)
    assert neighbours.nearest(frame(spark, [])).count() == 0
    assert neighbours.nearest(frame(spark, [(20, [1.0])])).count() == 0


@pytest.mark.parametrize("lengths", [False, True])
def test_recall_over_shards(spark, lengths):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(1500, 24)) * (draw.uniform(0.2, 3, (1500, 1)) if lengths else 1)
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    found = {(r.query_id, r.vec_id): r.score for r in neighbours.nearest(frame(spark, rows), shard=400).collect()}
    want = {(q, i) for q, _, i in brute(rows)}
    assert len(set(found) & want) >= 0.9 * len(want)
    assert all(s == pytest.approx(np.dot(np.float64(rows[q][1]), np.float64(rows[i][1])), rel=1e-12) for (q, i), s in found.items())


@pytest.mark.parametrize("length", [1e4, 1e30])
def test_one_long_vector_spoils_no_graph(spark, length):
    x = np.random.default_rng(4).normal(size=(2000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[7] *= length
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    found = {(r.query_id, r.vec_id) for r in neighbours.nearest(frame(spark, rows)).collect()}
    want = {(q, i) for q, _, i in brute(rows)}
    assert len(found & want) >= 0.95 * len(want)
