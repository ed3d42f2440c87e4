"""Known results on small invented files, worked out by hand."""

import pytest

from keelson.operators import keyed, models, ranking
from keelson.operators import similarity as sim
from keelson.sources import read_delimited, read_inferred

PEOPLE = """0,Ann,13,10
1,Bo,13,21
2,Cy,19,5
3,Di,20,7
4,Ed,40,100
5,Flo,40,101
6,Gus,40,103
"""
# Users 1 to 3 rate items 10 and 20 alike; item 30 has one rater.
RATINGS = """1\t10\t4\t1
1\t20\t4\t2
2\t10\t2\t3
2\t20\t2\t4
3\t10\t5\t5
3\t20\t4\t6
3\t30\t1\t7
"""
HOUSES = """No,Age,Price
1,10.0,30.0
2,20.0,50.0
3,30.0,40.0
"""


@pytest.fixture
def written(tmp_path):
    def write(text):
        path = tmp_path / "data.txt"
        path.write_text(text)
        return str(path)

    return write


def test_people(spark, written):
    df = read_delimited(spark, written(PEOPLE), "id int, name string, age int, friends int")
    assert df.where("age >= 13 AND age <= 19").count() == 3
    assert [tuple(r) for r in keyed.histogram(df, "age").collect()] == [(13, 2), (19, 1), (20, 1), (40, 3)]
    for places, want in ((1, 101.3), (2, 101.33)):
        means = {r.age: r["mean"] for r in keyed.mean_by(df, ["age"], "friends", places).collect()}
        assert means == {13: 15.5, 19: 5.0, 20: 7.0, 40: want}


def test_ratings(spark, written):
    df = read_delimited(spark, written(RATINGS), "user int, item int, rating int, time bigint", sep="\t")
    best = ranking.top_k(df.groupBy("item").count(), ["-count", "item"], 2).collect()
    assert [tuple(r) for r in best] == [(10, 3), (20, 3)]
    scores = {(r.item_x, r.item_y): (r.score, r.strength) for r in sim.cosine(sim.item_pairs(sim.unique_ratings(df))).collect()}
    # 4*4 + 2*2 + 5*4 = 40, over the roots of 16 + 4 + 25 = 45 and 16 + 4 + 16 = 36.
    assert scores[10, 20] == (pytest.approx(40 / (45 * 36) ** 0.5), 3)
    assert scores[10, 30] == (pytest.approx(1.0), 1) and set(scores) == {(10, 20), (10, 30), (20, 30)}
    assert [(r.item, r.strength) for r in sim.similar_items(sim.unique_ratings(df), 10, 0.97, 2).collect()] == [(20, 3)]


def test_houses(spark, written):
    df = read_inferred(spark, written(HOUSES))
    rows = models.assemble(df, ["Age"], "Price")
    # Without regularisation the line through the three points has slope 0.5 and intercept 30.
    line = models.linear_regression(rows, reg=0.0, elastic_net=0.0, max_iter=50)
    assert line.coefficients[0] == pytest.approx(0.5, abs=1e-6) and line.intercept == pytest.approx(30, abs=1e-5)
    table = models.prediction_table(line, rows, ["No"])
    assert models.rmse(table) == pytest.approx((150 / 3) ** 0.5)
