"""Train and test splits of the events and line items."""

from __future__ import annotations

from keelson.operators import splits
from keelson.plans.registry import query
from keelson.sources import table

WEIGHTS, SEED = (0.7, 0.3), 42
CUT = splits.hash_cuts(WEIGHTS)[0]


def _events(spark, folder):
    return table(spark, folder, "events").select("event_id", "ts", "user_id", "value")


LEAVE_SQL = """
    WITH ranked AS (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events),
    capped AS (
        SELECT *, CASE WHEN r BETWEEN {start} AND {stop} THEN
            row_number() OVER (PARTITION BY r BETWEEN {start} AND {stop} ORDER BY ts, event_id) END AS t
        FROM ranked)
    SELECT event_id, ts, user_id, value, CASE WHEN t <= {cap} THEN 'test' ELSE 'base' END AS part FROM capped
"""


@query(LEAVE_SQL.format(start=1, stop=10, cap=1 << 60))
def leave_first_ten_out(spark, folder):
    return splits.leave_n_out(_events(spark, folder), ["user_id"], ["ts", "event_id"], 1, 10)


@query(LEAVE_SQL.format(start=11, stop=20, cap=1 << 60))
def leave_next_ten_out(spark, folder):
    return splits.leave_n_out(_events(spark, folder), ["user_id"], ["ts", "event_id"], 11, 20)


@query(LEAVE_SQL.format(start=1, stop=10, cap=100))
def leave_n_out_capped(spark, folder):
    return splits.leave_n_out(_events(spark, folder), ["user_id"], ["ts", "event_id"], 1, 10, max_test=100)


@query("""
    WITH ranked AS (
        SELECT *, row_number() OVER (ORDER BY ts, event_id) AS r, count(*) OVER () AS n FROM events)
    SELECT event_id, ts, user_id, value,
           CAST(1 + (r > n // 5)::INT + (r > 2 * n // 5)::INT + (r > 3 * n // 5)::INT
                + (r > 4 * n // 5)::INT AS INTEGER) AS fold
    FROM ranked
""")
def k_fold(spark, folder):
    return splits.k_fold(_events(spark, folder), ["ts", "event_id"], 5)


@query(f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(substr(md5(l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':{SEED}'), 1, 8) >= '{CUT}'
                AS INTEGER) AS part
    FROM lineitem
""")
def hash_split(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return splits.hash_split(lines, ["l_orderkey", "l_linenumber", "l_partkey"], WEIGHTS, SEED)
