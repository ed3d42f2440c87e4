"""Product kinds bought by the same customers, compared by cosine of the largest quantity bought."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import similarity as sim
from keelson.operators.ranking import attach_name
from keelson.plans.registry import query
from keelson.sources import table

ITEM = "Brand#10 STANDARD"
MIN_SCORE, MIN_STRENGTH = 0.80, 50

RATINGS_SQL = """
    ratings AS (
        SELECT o_custkey AS u, {item} AS item, CAST(max(l_quantity) AS BIGINT) AS rating
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey {part} GROUP BY ALL),
    pairs AS (
        SELECT x.item AS item_x, y.item AS item_y, sum(x.rating * x.rating) AS xx,
               sum(x.rating * y.rating) AS xy, sum(y.rating * y.rating) AS yy, count(*) AS strength
        FROM ratings x JOIN ratings y ON x.u = y.u AND x.item < y.item GROUP BY ALL),
    scores AS (
        SELECT item_x, item_y, strength,
               CASE WHEN xx = 0 OR yy = 0 THEN 0
                    ELSE CAST(xy AS DOUBLE) / (sqrt(CAST(xx AS DOUBLE)) * sqrt(CAST(yy AS DOUBLE))) END AS score
        FROM pairs)
"""
KIND_SQL = "WITH " + RATINGS_SQL.format(
    item="p_brand || ' ' || p_type", part="JOIN part ON l_partkey = p_partkey"
)


def _kinds(spark, folder):
    parts = table(spark, folder, "part")
    return parts.select("p_partkey", "p_name", F.concat_ws(" ", "p_brand", "p_type").alias("item"))


def kind_ratings(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("user"))
    kinds = _kinds(spark, folder).select("p_partkey", "item")
    # Kinds first: a filter on one kind then thins the line items before they meet the orders.
    bought = lines.join(kinds, lines.l_partkey == kinds.p_partkey)
    bought = bought.join(orders, bought.l_orderkey == orders.o_orderkey)
    return sim.unique_ratings(bought.select("user", "item", F.col("l_quantity").alias("rating")))


def part_ratings(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", F.col("l_partkey").alias("item"), "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("user"))
    bought = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return sim.unique_ratings(bought.select("user", "item", F.col("l_quantity").alias("rating")))


@query(KIND_SQL + """
    SELECT item_x, item_y, CAST(xx AS DOUBLE) AS sum_xx, CAST(xy AS DOUBLE) AS sum_xy,
           CAST(yy AS DOUBLE) AS sum_yy, strength
    FROM pairs
""")
def item_pairs(spark, folder):
    return sim.item_pairs(kind_ratings(spark, folder))


@query(KIND_SQL + "SELECT item_x, item_y, round(score, 6) AS score, strength FROM scores")
def item_cosine(spark, folder):
    scores = sim.cosine(sim.item_pairs(kind_ratings(spark, folder)))
    return scores.withColumn("score", F.round("score", 6))


SIMILAR_SQL = KIND_SQL + """,
    best AS (
        SELECT CASE WHEN item_x <> '{item}' THEN item_x ELSE item_y END AS item, score, strength FROM scores
        WHERE (item_x = '{item}' OR item_y = '{item}') AND score > {score} AND strength > {strength}
        ORDER BY score DESC, strength DESC, item LIMIT 10)
    SELECT item, round(score, 3) AS score, strength, (SELECT min(p_name) FROM part
        WHERE p_brand || ' ' || p_type = item) AS title FROM best
"""


def similar_to(spark, folder, min_strength):
    best = sim.similar_items(kind_ratings(spark, folder), ITEM, MIN_SCORE, min_strength)
    titles = _kinds(spark, folder).groupBy("item").agg(F.min("p_name").alias("title"))
    return attach_name(best, titles, "item", few=10).orderBy(F.desc("score"), F.desc("strength"), "item")


@query(SIMILAR_SQL.format(item=ITEM, score=MIN_SCORE, strength=MIN_STRENGTH))
def similar_items(spark, folder):
    return similar_to(spark, folder, MIN_STRENGTH)


@query(KIND_SQL + f"""
    SELECT CASE WHEN item_x <> '{ITEM}' THEN item_x ELSE item_y END AS item, round(score, 6) AS score, strength
    FROM scores WHERE (item_x = '{ITEM}' OR item_y = '{ITEM}') AND score > {MIN_SCORE} AND strength > {MIN_STRENGTH}
""")
def similar_pairs_filter(spark, folder):
    """The pairs above the thresholds, and of them those of one item."""
    scores = sim.similar_pairs(kind_ratings(spark, folder), MIN_SCORE, MIN_STRENGTH)
    similar = sim.filter_similar(scores, ITEM, MIN_SCORE, MIN_STRENGTH)
    return similar.withColumn("score", F.round("score", 6))


PART_SCORE, PART_STRENGTH = 0.9, 3


@query("WITH " + RATINGS_SQL.format(item="l_partkey", part="") + f"""
    SELECT item_x, item_y, round(score, 6) AS score, strength FROM scores
    WHERE score > {PART_SCORE} AND strength > {PART_STRENGTH}
""")
def similar_part_pairs(spark, folder):
    """Single parts that enough customers bought in like amounts: few of very many pairs."""
    scores = sim.similar_pairs(part_ratings(spark, folder), PART_SCORE, PART_STRENGTH)
    return scores.withColumn("score", F.round("score", 6))


@query("WITH " + RATINGS_SQL.format(item="l_partkey", part="") + """
    SELECT strength, count(*) AS n_pairs, CAST(sum(xy) AS DOUBLE) AS sum_xy FROM pairs GROUP BY strength
""")
def part_pair_strengths(spark, folder):
    """How many pairs of single parts share how many customers: almost as many pairs as pair rows."""
    pairs = sim.item_pairs(part_ratings(spark, folder))
    return pairs.groupBy("strength").agg(F.count(F.lit(1)).alias("n_pairs"), F.sum("sum_xy").alias("sum_xy"))
