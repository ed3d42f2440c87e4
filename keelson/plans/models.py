"""Recommendation and price regression on the trade tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from keelson.operators import models
from keelson.operators.keyed import sum_by
from keelson.operators.ranking import attach_name, top_k
from keelson.operators.splits import hash_cuts, hash_split
from keelson.plans.registry import query
from keelson.plans.similarity import part_ratings
from keelson.session import keep
from keelson.sources import table

KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]
WEIGHTS, SEED = (0.7, 0.3), 7
TRAIN_SQL = (
    f"substr(md5(l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':{SEED}'), 1, 8) "
    f"< '{hash_cuts(WEIGHTS)[0]}'"
)


def _recommended(spark, folder, users, k):
    """``(user, item, score, rank)`` for the users of ``users (user)`` that bought anything."""
    # Stored once: numbering, fit and names all read them.
    ratings = keep(part_ratings(spark, folder), "part-ratings")
    buyers = keep(models.numbered(ratings, "user"), "buyers")
    parts = keep(models.numbered(ratings, "item"), "bought-parts")
    dense = (
        ratings.join(buyers.withColumnRenamed("number", "u"), "user")
        .join(parts.withColumnRenamed("number", "i"), "item")
        .select(F.col("u").alias("user"), F.col("i").alias("item"), F.col("rating").cast("float"))
    )
    asked = users.join(buyers, "user").select("user", "number")
    best = models.als_recommend(models.als_model(dense), asked.select(F.col("number").alias("user")), k)
    named = best.withColumnRenamed("user", "number").join(asked, "number").drop("number")
    return named.withColumnRenamed("item", "number").join(parts, "number").select("user", "item", "score", "rank")


def _top_spenders(spark, folder):
    spent = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("user"), F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    )
    return top_k(sum_by(spent, ["user"], "price", ascending=None), ["-total", "user"], 10).select("user")


@query()
def als_recommend(spark, folder):
    """Ten parts for each of the ten customers who spent most, learnt from all purchases."""
    best = _recommended(spark, folder, _top_spenders(spark, folder), 10)
    names = table(spark, folder, "part").select(F.col("p_partkey").alias("item"), "p_name")
    return attach_name(best, names, "item", few=100)


@query("""
    SELECT o_custkey AS user, 10 AS items, 10 AS ranks, 0 AS rises, 0 AS strangers FROM
      (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total FROM orders
       GROUP BY 1 ORDER BY total DESC, o_custkey LIMIT 10)
    WHERE o_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
""")
def als_facts(spark, folder):
    """What must hold of any recommendation: ten parts of the table, ranked, scores not rising."""
    best = als_recommend(spark, folder)
    before = F.lag("score").over(Window.partitionBy("user").orderBy("rank"))
    marked = best.withColumn("rise", (F.col("score") > before).cast("int"))
    return marked.groupBy("user").agg(
        F.count_distinct("item").cast("int").alias("items"),
        F.max("rank").cast("int").alias("ranks"),
        F.coalesce(F.sum("rise"), F.lit(0)).cast("int").alias("rises"),
        F.sum(F.col("p_name").isNull().cast("int")).cast("int").alias("strangers"),
    )


GIVEN = [1, 2, -1]


@query(f"""
    SELECT CAST(id AS BIGINT) AS user, CAST(CASE WHEN id IN (
        SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey) THEN 5 ELSE 0 END AS INTEGER) AS items
    FROM (SELECT unnest({GIVEN}) AS id)
""")
def als_for_given_ids(spark, folder):
    """Recommendations for ids given in memory; one that the model has never seen gets none."""
    users = spark.createDataFrame([(i,) for i in GIVEN], "user bigint")
    counts = _recommended(spark, folder, users, 5).groupBy("user").agg(F.count_distinct("item").alias("n"))
    return users.join(counts, "user", "left").select("user", F.coalesce("n", F.lit(0)).cast("int").alias("items"))


def _split(spark, folder, features):
    lines = table(spark, folder, "lineitem").select(*KEYS, *features, "l_extendedprice")
    labelled = hash_split(lines, KEYS, WEIGHTS, SEED)
    rows = models.assemble(labelled, features, "l_extendedprice")
    return rows.where("part = 0"), rows.where("part = 1")


@query()
def tree_regression(spark, folder):
    """Price of each held-out line item from quantity, discount and tax, by a decision tree."""
    train, test = _split(spark, folder, ["l_quantity", "l_discount", "l_tax"])
    return models.prediction_table(models.tree_regression(train), test, KEYS)


@query(f"""
    WITH means AS (
        SELECT l_quantity, avg(l_extendedprice) AS m FROM lineitem WHERE {TRAIN_SQL} GROUP BY l_quantity)
    SELECT count(*) AS n, round(sqrt(avg((m - l_extendedprice) * (m - l_extendedprice))), 4) AS rmse
    FROM lineitem JOIN means USING (l_quantity) WHERE NOT {TRAIN_SQL}
""")
def rmse_baseline(spark, folder):
    """Error of predicting the mean price of the training rows with the same quantity."""
    lines = table(spark, folder, "lineitem").select(*KEYS, "l_quantity", F.col("l_extendedprice").alias("y_data"))
    rows = hash_split(lines, KEYS, WEIGHTS, SEED)
    means = rows.where("part = 0").groupBy("l_quantity").agg(F.avg("y_data").alias("y_model"))
    scored = rows.where("part = 1").join(means, "l_quantity")
    return models.rmse_table(scored).withColumn("rmse", F.round("rmse", 4))


# One feature, so the elastic net has a closed form: soft threshold, then shrink.
LINE_SQL = f"""
    WITH train AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem WHERE {TRAIN_SQL}),
    moments AS (
        SELECT avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sx, stddev_pop(y) AS sy, covar_pop(x, y) AS cov
        FROM train),
    fit AS (
        SELECT mx, my, sign(cov) * greatest(abs(cov / (sx * sy)) - 0.8 * 0.3 / sy, 0)
                       / (1 + 0.2 * 0.3 / sy) * sy / sx AS slope
        FROM moments)
"""


@query(LINE_SQL + "SELECT round(slope, 2) AS slope, round(my - slope * mx, 1) AS intercept FROM fit")
def linear_regression(spark, folder):
    """Elastic-net line of price on quantity, as its two coefficients."""
    train, _ = _split(spark, folder, ["l_quantity"])
    model = models.linear_regression(train)
    return spark.range(1).select(
        F.round(F.lit(float(model.coefficients[0])), 2).alias("slope"),
        F.round(F.lit(float(model.intercept)), 1).alias("intercept"),
    )


@query(LINE_SQL + f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice AS y_data,
           round(my + slope * (l_quantity - mx), 0) AS y_model
    FROM lineitem, fit WHERE NOT {TRAIN_SQL}
""")
def linear_predictions(spark, folder):
    """True and predicted price of each held-out line item, with the feature behind it."""
    train, test = _split(spark, folder, ["l_quantity"])
    found = models.prediction_table(models.linear_regression(train), test, [*KEYS, "l_quantity"])
    return found.withColumn("y_model", F.round("y_model", 0))


STUMP_SQL = f"""
    WITH groups AS (
        SELECT l_quantity AS x, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS s
        FROM lineitem WHERE {TRAIN_SQL} GROUP BY 1),
    sums AS (
        SELECT x, CAST(sum(n) OVER below AS DOUBLE) AS n, CAST(sum(s) OVER below AS DOUBLE) AS s,
               CAST(sum(n) OVER () AS DOUBLE) AS n_all, CAST(sum(s) OVER () AS DOUBLE) AS s_all
        FROM groups WINDOW below AS (ORDER BY x)),
    -- The split that leaves the least variance makes the sum of squared sums over counts largest.
    best AS (
        SELECT x AS cut, s / n AS low, (s_all - s) / (n_all - n) AS high FROM sums WHERE n < n_all
        ORDER BY s * s / n + (s_all - s) * (s_all - s) / (n_all - n) DESC LIMIT 1),
    found AS (
        SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS y_data,
               CASE WHEN l_quantity <= cut THEN low ELSE high END AS y_model
        FROM lineitem, best WHERE NOT {TRAIN_SQL})
"""


def _stump(spark, folder):
    train, test = _split(spark, folder, ["l_quantity"])
    # At least as many bins as values: every split between two values is tried.
    return models.prediction_table(models.tree_regression(train, maxDepth=1, maxBins=64), test, KEYS)


@query(STUMP_SQL + "SELECT * REPLACE (round(y_model, 4) AS y_model) FROM found")
def tree_stump(spark, folder):
    """A tree of one split, which SQL can find too."""
    return _stump(spark, folder).withColumn("y_model", F.round("y_model", 4))


@query(STUMP_SQL + """
    SELECT count(*) AS n, round(sqrt(avg((y_model - y_data) * (y_model - y_data))), 4) AS rmse FROM found
""")
def tree_stump_rmse(spark, folder):
    return models.rmse_table(_stump(spark, folder)).withColumn("rmse", F.round("rmse", 4))


@query()
def tree_rmse(spark, folder):
    """Error of the decision tree on the held-out line items."""
    return models.rmse_table(tree_regression(spark, folder))
