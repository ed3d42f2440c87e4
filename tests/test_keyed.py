from decimal import Decimal

from pyspark.sql import functions as F

from keelson.functions import affine, other_side, safe_ratio, to_ascii, words
from keelson.operators import keyed


def test_words_unicode_and_ascii(spark):
    df = spark.createDataFrame([(" Café, naïve! it's ",)], "value string")
    got = df.select(words(F.col("value")).alias("u"), words(F.col("value"), False).alias("a")).first()
    assert got.u == ["", "café", "naïve", "it", "s", ""]
    assert got.a == ["", "caf", "na", "ve", "it", "s", ""]


def test_word_counts_options(spark):
    df = spark.createDataFrame([("One two, TWO.",), ("é two é",)], "value string")

    def counts(**options):
        return {r.word: r.n for r in keyed.word_counts(df, "value", **options).collect()}

    assert counts() == {"one": 1, "two": 3, "é": 2}
    assert counts(keep_empty=True) == {"one": 1, "two": 3, "é": 2, "": 1}
    assert counts(ascii_only=True) == {"one": 1, "two": 3}
    assert counts(unicode=False) == {"one": 1, "two": 3}


def test_scalar_expressions(spark):
    row = spark.range(1).select(
        affine(F.lit(-75), 0.18, 32.0, 2).alias("f"),
        safe_ratio(F.lit(1.0), F.lit(0.0)).alias("zero"),
        safe_ratio(F.lit(1.0), F.lit(0.0), None).alias("null"),
        safe_ratio(F.lit(1.0), F.lit(4.0)).alias("ratio"),
        to_ascii(F.lit("naïve")).alias("ascii"),
        other_side(F.lit(1), F.lit(2), F.lit(1)).alias("other"),
    ).first()
    assert tuple(row) == (18.5, 0.0, None, 0.25, "nave", 2)


def test_means_sums_and_extremes(spark):
    df = spark.createDataFrame([(1, 10, 2.0), (1, 20, 3.0), (2, 5, 1.5)], "k int, a int, b double")
    assert {r.k: r["mean"] for r in keyed.mean_by(df, ["k"], "b", 1).collect()} == {1: 2.5, 2: 1.5}
    every = {r.k: r.asDict() for r in keyed.mean_all(df, ["k"]).collect()}
    assert every[1] == {"k": 1, "avg_k": 1.0, "avg_a": 15.0, "avg_b": 2.5}
    assert [tuple(r) for r in keyed.sum_by(df, ["k"], "b").collect()] == [(2, 1.5), (1, 5.0)]
    assert [r.k for r in keyed.sum_by(df, ["k"], "b", ascending=False).collect()] == [1, 2]
    assert {r.k: r.max_a for r in keyed.extreme_by(df, ["k"], "a", "max").collect()} == {1: 20, 2: 5}
    assert tuple(keyed.global_agg(df, "a").first()) == (5, 20, 3)
    assert [tuple(r) for r in keyed.histogram(df, "k").collect()] == [(1, 2), (2, 1)]


def test_a_mean_of_decimals_is_rounded_once(spark):
    rows = [
        (1, "4201.31"), (1, "4201.32"),  # 4201.315: a tie that no binary quotient holds
        (2, "-0.01"), (2, "0.00"),  # -0.005: halves go away from zero
        (3, "1.00"), (3, "1.00"), (3, "1.01"), (4, None),
    ]
    df = spark.createDataFrame(rows, "k int, m string").withColumn("m", F.col("m").cast("decimal(18,2)"))
    found = {r.k: r["mean"] for r in keyed.mean_by(df, ["k"], "m", 2).collect()}
    assert found == {1: Decimal("4201.32"), 2: Decimal("-0.01"), 3: Decimal("1.00"), 4: None}
    assert {r.k: r["mean"] for r in keyed.mean_by(df, ["k"], "m", 1).collect()}[1] == Decimal("4201.3")
    # Just below a half, by less than twelve digits show.
    near = spark.range(3).select(F.lit(1).alias("k"), F.lit(Decimal("0.004999")).alias("m"))
    assert keyed.mean_by(near, ["k"], "m", 2).first()["mean"] == Decimal("0.00")


def test_tie_in_the_sql_of_the_means(spark, tmp_path):
    import duckdb

    from keelson.plans import oracles, queries

    rows = [(i, "c", n, m, "s") for i, (n, m) in enumerate([(17, 4201.31), (17, 4201.32), (3, -0.01), (3, 0.0)])]
    spark.createDataFrame(rows, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string") \
        .coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    got = sorted(map(tuple, queries()["mean_by_key_sql"](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert got == sorted(con.execute(oracles()["mean_by_key_sql"]).fetchall()) == [(3, -0.01), (17, 4201.32)]
