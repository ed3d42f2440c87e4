import math
import random
from itertools import combinations

import pytest

from keelson.operators import similarity as sim


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    # User 0 rated every item and item "i0" has a rating of every user.
    out = [(0, f"i{i}", rng.randint(1, 5)) for i in range(40)]
    for user in range(1, 60):
        out += [(user, f"i{i}", rng.randint(1, 5)) for i in {0, *rng.sample(range(40), 5)}]
    return out


def brute(rows):
    by_user, pairs = {}, {}
    for user, item, rating in rows:
        by_user.setdefault(user, {})[item] = rating
    for rated in by_user.values():
        for x, y in combinations(sorted(rated), 2):
            s = pairs.setdefault((x, y), [0, 0, 0, 0])
            for i, v in enumerate((rated[x] ** 2, rated[x] * rated[y], rated[y] ** 2, 1)):
                s[i] += v
    return {k: tuple(v) for k, v in pairs.items()}


def table(spark, rows):
    return spark.createDataFrame(rows, "user bigint, item string, rating double")


def floats(rows):
    return [(u, i, float(r)) for u, i, r in rows]


@pytest.mark.parametrize("unit", [256, 4, 1])
def test_pairs_equal_brute_force(spark, monkeypatch, rows, unit):
    """With small units the user with most items is cut into many."""
    monkeypatch.setattr(sim, "UNIT_ITEMS", unit)
    got = sim.item_pairs(sim.unique_ratings(table(spark, floats(rows)))).collect()
    assert {(r.item_x, r.item_y): (r.sum_xx, r.sum_xy, r.sum_yy, r.strength) for r in got} == brute(rows)
    assert len(got) == len(brute(rows))


def test_number_items(spark, rows):
    numbered = [(u, int(i[1:]), r) for u, i, r in rows]
    ratings = spark.createDataFrame(floats(numbered), "user bigint, item int, rating double")
    got = {(r.item_x, r.item_y): r.strength for r in sim.item_pairs(ratings).collect()}
    assert got == {k: v[3] for k, v in brute(numbered).items()}


def test_min_strength_only_drops_weak_pairs(spark, rows):
    ratings = table(spark, floats(rows))
    got = {(r.item_x, r.item_y) for r in sim.item_pairs(ratings, min_strength=3).collect()}
    assert got == {k for k, v in brute(rows).items() if v[3] >= 3}


def test_scores(spark, rows):
    scores = sim.cosine(sim.item_pairs(table(spark, floats(rows)))).collect()
    want = brute(rows)
    for r in scores:
        xx, xy, yy, n = want[r.item_x, r.item_y]
        assert r.item_x < r.item_y and 0 <= r.score <= 1 + 1e-12 and r.strength == n
        assert math.isclose(r.score, xy / (math.sqrt(xx) * math.sqrt(yy)))


def test_zero_norm(spark):
    ratings = table(spark, [(1, "a", 0.0), (1, "b", 5.0)])
    pairs = sim.item_pairs(ratings)
    assert sim.cosine(pairs).first().score == 0.0
    assert sim.cosine(pairs, zero=None).first().score is None
    assert sim.similarity_to(ratings, "a").first().score == 0.0


def test_one_item_equals_its_rows_of_all_pairs(spark, rows):
    ratings = table(spark, floats(rows))
    scores = sim.cosine(sim.item_pairs(ratings))
    for item in ("i0", "i7", "none"):
        whole = sim.filter_similar(scores, item, min_score=0.8, min_strength=2)
        direct = sim.similarity_to(ratings, item).where("score > 0.8 AND strength > 2")
        as_set = [{(r.item, round(r.score, 9), r.strength) for r in df.collect()} for df in (whole, direct)]
        assert as_set[0] == as_set[1]
        best = sim.similar_items(ratings, item, 0.8, 2, 4).collect()
        want = sorted(as_set[0], key=lambda t: (-t[1], -t[2], t[0]))[:4]
        assert [r.item for r in best] == [t[0] for t in want]


def test_repeated_ratings_count_once(spark):
    ratings = table(spark, [(1, "a", 2.0), (1, "a", 4.0), (1, "b", 3.0), (None, "b", 1.0), (2, None, 1.0)])
    unique = sim.unique_ratings(ratings)
    assert sorted(tuple(r) for r in unique.collect()) == [(1, "a", 4.0), (1, "b", 3.0)]


@pytest.mark.parametrize("least", [0, 1, 2, 5, 8])
def test_pairs_above_thresholds(spark, rows, least):
    ratings = table(spark, floats(rows) + [(u, "z", 0.0) for u in range(30)])
    want = {
        k: (xy / math.sqrt(xx * yy), n) for k, (xx, xy, yy, n) in brute(rows).items() if xx and yy
    }
    for score in (0.5, 0.9):
        got = {(r.item_x, r.item_y): (r.score, r.strength) for r in sim.similar_pairs(ratings, score, least).collect()}
        assert set(got) == {k for k, (s, n) in want.items() if s > score and n > least}
        for k, (s, n) in got.items():
            assert n == want[k][1] and math.isclose(s, want[k][0])


def test_few_pairs_are_candidates(spark):
    """Everybody rated many items, but only items of one group by the same users."""
    rng = random.Random(9)
    rated = []
    for user in range(120):
        group = user % 6
        rated += [(user, f"g{group}-{i}", float(rng.randint(3, 5))) for i in range(8)]
        rated += [(user, f"x{i}", float(rng.choice([1, 5]))) for i in rng.sample(range(150), 30)]
    ratings = table(spark, rated)
    every = sim.item_pairs(ratings).count()
    found, _, _ = sim.pair_candidates(ratings, 0.9, 9)
    passed = sim.similar_pairs(ratings, 0.9, 9).count()
    scores = sim.cosine(sim.item_pairs(ratings))
    assert passed == scores.where("score > 0.9 AND strength > 9").count() > 100
    assert passed <= found.count() < every / 5


@pytest.mark.parametrize("unit, task", [(256, 1 << 22), (256, 20), (4, 1 << 22), (1, 5)])
def test_listed_pairs_equal_brute_force(spark, monkeypatch, unit, task):
    """Where most pairs occur once each moves in a list and is summed where it arrives; hot items apart."""
    monkeypatch.setattr(sim, "UNIT_ITEMS", unit)
    monkeypatch.setattr(sim, "TASK_PAIRS", task)
    rng = random.Random(3)
    ratings = [(u, i, r) for u in range(60) for i, r in {0: 3, 5000: 1.5} .items()]
    ratings += [(u, i, rng.choice([1, 2.5, 300, -4])) for u in range(60) for i in rng.sample(range(1, 4000), 7)]
    df = spark.createDataFrame([(u, i + 2**33, float(r)) for u, i, r in ratings] + [(None, 1, 1.0), (1, None, 1.0)], "user bigint, item bigint, rating double")
    pairs = sim.item_pairs(df)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    # Above where the lists are taken apart, that is before it in the plan, nothing is shuffled.
    assert "Exchange" not in plan.partition("posexplode(items")[0] and "posexplode(items" in plan
    got = {(r.item_x - 2**33, r.item_y - 2**33): (r.sum_xx, r.sum_xy, r.sum_yy, r.strength) for r in pairs.collect()}
    assert got == brute(ratings)
    assert pairs.count() == len(got) and pairs.schema == sim.item_pairs(df.limit(0)).schema


def test_tails_are_empty_where_no_user_stands_out(spark):
    """Heads would then be almost all ratings, and their pairs almost all pairs."""
    rng = random.Random(5)
    rated = [(u, i, float(rng.randint(1, 5))) for u in range(200) for i in rng.sample(range(12), 6)]
    ratings = spark.createDataFrame(rated, "user bigint, item bigint, rating double")
    found, head, tail = sim.pair_candidates(ratings, 0.8, 3)
    assert head.count() == len(rated) and tail.count() == 0
    want = {k: n for k, (xx, xy, yy, n) in brute(rated).items() if n > 3 and xy / math.sqrt(xx * yy) > 0.8}
    assert {(r.item_x, r.item_y): r.strength for r in sim.similar_pairs(ratings, 0.8, 3).collect()} == want
    assert found.count() >= len(want) > 0
