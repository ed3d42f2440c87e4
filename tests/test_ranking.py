from keelson.operators.ranking import attach_name, bottom_ties, top_k, top_k_per_group


def scores(spark):
    return spark.createDataFrame([("a", 3, 1), ("b", 3, 2), ("c", 1, 3), ("d", 1, 4)], "id string, n int, x int")


def test_top_k_breaks_ties_by_the_last_key(spark):
    assert [r.id for r in top_k(scores(spark), ["-n", "-id"], 3).collect()] == ["b", "a", "d"]


def test_top_k_does_not_sort_everything(spark):
    plan = top_k(scores(spark), ["-n", "id"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_bottom_keeps_all_ties(spark):
    assert sorted(r.id for r in bottom_ties(scores(spark), "n").collect()) == ["c", "d"]


def test_missing_name_is_null(spark):
    names = spark.createDataFrame([("a", "Ann"), ("z", "Zoe")], "id string, name string")
    for few in (None, 100):
        got = {r.id: r.name for r in attach_name(scores(spark), names, "id", few=few).collect()}
        assert got == {"a": "Ann", "b": None, "c": None, "d": None}


def test_top_k_per_group_with_one_hot_group(spark):
    df = spark.range(5000).selectExpr("if(id % 3 = 0, 0, id % 50) AS k", "(id * 7919) % 5000 AS v")
    rows = [(r.k, r.v) for r in df.collect()]
    for k in (3, 1200):  # above the window-group limit the groups are trimmed in salted parts
        got = sorted((r.k, r["rank"], r.v) for r in top_k_per_group(df, ["k"], ["-v"], k).collect())
        want = []
        for key in {k for k, _ in rows}:
            best = sorted((v for k, v in rows if k == key), reverse=True)[:k]
            want += [(key, i + 1, v) for i, v in enumerate(best)]
        assert got == sorted(want)


def test_small_k_is_trimmed_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = top_k_per_group(df, ["k"], ["-v"], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
