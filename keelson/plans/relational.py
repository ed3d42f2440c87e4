"""Projections, filters, keyed aggregation, ranking and lookups on the trade tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions import affine
from keelson.operators.keyed import extreme_by, global_agg, histogram, mean_all, mean_by, sum_by
from keelson.operators.ranking import attach_name, bottom_ties, top_k, top_k_per_group
from keelson.plans.registry import query
from keelson.sources import table


@query("""
    SELECT c_custkey, c_name, c_mktsegment AS segment, c_acctbal + 10 AS raised_balance FROM customer
""")
def select_shift(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        "c_name",
        F.col("c_mktsegment").alias("segment"),
        (F.col("c_acctbal") + 10).alias("raised_balance"),
    )


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 0")
def filter_below(spark, folder):
    customers = table(spark, folder, "customer")
    return customers.where(F.col("c_acctbal") < 0).select("c_custkey", "c_name", "c_acctbal")


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_totalprice >= 100000 AND o_totalprice <= 150000
""")
def filter_range_sql(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("priced_orders")
    return spark.sql("""
        SELECT o_orderkey, o_custkey, o_totalprice FROM priced_orders
        WHERE o_totalprice >= 100000 AND o_totalprice <= 150000
    """)


@query("""
    SELECT user_id, round(min(value) * 1.8 + 32, 2) AS low, round(max(value) * 1.8 + 32, 2) AS high
    FROM events WHERE contains(event_type, 'e') GROUP BY user_id
""")
def filter_contains(spark, folder):
    # The conversion is increasing, so it can wait until after the aggregate: one per key.
    return (
        table(spark, folder, "events")
        .where(F.col("event_type").contains("e"))
        .groupBy("user_id")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
        .select("user_id", *(affine(F.col(c), 1.8, 32.0, 2).alias(c) for c in ("low", "high")))
    )


@query("""
    SELECT user_id, max(value) AS max_value FROM events WHERE event_type = 'purchase' GROUP BY user_id
""")
def max_by_key(spark, folder):
    purchases = table(spark, folder, "events").where(F.col("event_type") == "purchase")
    return extreme_by(purchases, ["user_id"], "value", "max")


@query("""
    SELECT user_id, min(value) AS min_value FROM events WHERE event_type <> 'error' GROUP BY user_id
""")
def min_by_key(spark, folder):
    events = table(spark, folder, "events").where(F.col("event_type") != "error")
    return extreme_by(events, ["user_id"], "value", "min")


@query("SELECT l_linenumber, count(*) AS n FROM lineitem GROUP BY l_linenumber ORDER BY l_linenumber")
def value_histogram(spark, folder):
    return histogram(table(spark, folder, "lineitem"), "l_linenumber")


# Whole cents, halves up: no quotient is rounded before, and none is binary.
MEAN_SQL = """
    SELECT {key}, CAST(sign(cents) * ((2 * abs(cents) + n) // (2 * n)) AS DOUBLE) / 100 AS {name}
    FROM (SELECT {key}, CAST(sum(CAST({money} AS DECIMAL(18, 2))) * 100 AS HUGEINT) AS cents, count({money}) AS n
          FROM {table} GROUP BY {key})
"""


@query(MEAN_SQL.format(key="o_orderpriority", money="o_totalprice", name="mean_price", table="orders"))
def mean_by_key(spark, folder):
    """Money is summed as decimals: a mean of doubles depends on the order of the rows."""
    exact = table(spark, folder, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    means = mean_by(exact, ["o_orderpriority"], "o_totalprice", 2, "mean_price")
    return means.withColumn("mean_price", F.col("mean_price").cast("double"))


@query(MEAN_SQL.format(key="c_nationkey", money="c_acctbal", name="mean_balance", table="customer"))
def mean_by_key_sql(spark, folder):
    """Grouping, a rounded mean and an order, all in SQL text over a view."""
    table(spark, folder, "customer").createOrReplaceTempView("banked_customers")
    return spark.sql("""
        WITH sums AS (
            SELECT c_nationkey, CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) * 100 AS DECIMAL(38, 0)) AS cents,
                   count(c_acctbal) AS n
            FROM banked_customers GROUP BY c_nationkey)
        SELECT c_nationkey, signum(cents) * ((2 * abs(cents) + n) div (2 * n)) / 100 AS mean_balance
        FROM sums ORDER BY mean_balance DESC, c_nationkey
    """)


@query("""
    SELECT c_mktsegment, round(avg(c_custkey), 4) AS avg_c_custkey,
           round(avg(c_nationkey), 4) AS avg_c_nationkey, round(avg(c_acctbal), 4) AS avg_c_acctbal
    FROM customer GROUP BY c_mktsegment
""")
def mean_all_numeric(spark, folder):
    return mean_all(table(spark, folder, "customer"), ["c_mktsegment"], 4)


@query("""
    SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_spent
    FROM orders GROUP BY o_custkey ORDER BY total_spent, o_custkey
""")
def sum_by_key(spark, folder):
    # Money is summed as decimal: exact, so independent of the order of the partial sums.
    orders = table(spark, folder, "orders")
    exact = orders.select("o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    return sum_by(exact, ["o_custkey"], "price", alias="total_spent").withColumn(
        "total_spent", F.col("total_spent").cast("double")
    )


@query("""
    SELECT min(o_totalprice) AS min_o_totalprice, max(o_totalprice) AS max_o_totalprice, count(*) AS n
    FROM orders
""")
def global_min(spark, folder):
    return global_agg(table(spark, folder, "orders"), "o_totalprice")


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def set_membership(spark, folder):
    indebted = table(spark, folder, "customer").where(F.col("c_acctbal") < 0)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.join(indebted, orders.o_custkey == indebted.c_custkey, "left_semi")


@query("""
    SELECT o_orderstatus, CASE WHEN o_totalprice >= 250000 THEN 'large' ELSE 'small' END AS size, count(*) AS n
    FROM orders GROUP BY ALL
""")
def conditional_groups(spark, folder):
    size = F.when(F.col("o_totalprice") >= 250000, "large").otherwise("small")
    orders = table(spark, folder, "orders").select("o_orderstatus", size.alias("size"))
    return orders.groupBy("o_orderstatus", "size").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT n_nationkey, n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY ALL
""")
def customers_by_nation(spark, folder):
    # Count first, name the few groups after: the join sees one row per nation.
    counts = table(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey"))
    counts = counts.agg(F.count(F.lit(1)).alias("customers"))
    return counts.join(table(spark, folder, "nation").select("n_nationkey", "n_name"), "n_nationkey")


@query("""
    SELECT p_partkey, p_name, n FROM
      (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 10)
    LEFT JOIN part ON p_partkey = l_partkey ORDER BY n DESC, p_partkey
""")
def popular_parts(spark, folder):
    counts = table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"))
    best = top_k(counts.agg(F.count(F.lit(1)).alias("n")), ["-n", "p_partkey"], 10)
    names = table(spark, folder, "part").select("p_partkey", "p_name")
    return attach_name(best, names, "p_partkey", few=10).orderBy(F.desc("n"), "p_partkey")


@query("""
    SELECT c_custkey, c_name, total_spent FROM
      (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_spent
       FROM orders GROUP BY 1 ORDER BY total_spent DESC, o_custkey LIMIT 1)
    LEFT JOIN customer ON c_custkey = o_custkey
""")
def top1_customer(spark, folder):
    exact = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    )
    totals = sum_by(exact, ["c_custkey"], "price", ascending=None, alias="total_spent")
    best = top_k(totals, ["-total_spent", "c_custkey"], 1)
    names = table(spark, folder, "customer").select("c_custkey", "c_name")
    return attach_name(best, names, "c_custkey", few=1).withColumn(
        "total_spent", F.col("total_spent").cast("double")
    )


LEAST_SQL = """
    WITH counts AS (SELECT l_partkey, count(*) AS n FROM lineitem WHERE {where} GROUP BY l_partkey)
    SELECT p_partkey, p_name, n FROM counts LEFT JOIN part ON p_partkey = l_partkey
    WHERE n = (SELECT min(n) FROM counts)
"""


def _least_ordered(spark, folder, lines):
    counts = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"))
    names = table(spark, folder, "part").select("p_partkey", "p_name")
    return attach_name(bottom_ties(counts, "n"), names, "p_partkey")


@query(LEAST_SQL.format(where="true"))
def least_ordered_parts(spark, folder):
    return _least_ordered(spark, folder, table(spark, folder, "lineitem"))


@query(LEAST_SQL.format(where="l_quantity >= 45"))
def least_bulk_ordered_parts(spark, folder):
    return _least_ordered(spark, folder, table(spark, folder, "lineitem").where(F.col("l_quantity") >= 45))


@query("""
    SELECT c_nationkey, o_orderkey, o_totalprice, rank FROM
      (SELECT c_nationkey, o_orderkey, o_totalprice, CAST(row_number() OVER
         (PARTITION BY c_nationkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank
       FROM orders JOIN customer ON c_custkey = o_custkey)
    WHERE rank <= 3
""")
def top_orders_per_nation(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return top_k_per_group(
        joined.select("c_nationkey", "o_orderkey", "o_totalprice"),
        ["c_nationkey"],
        ["-o_totalprice", "o_orderkey"],
        3,
    )
