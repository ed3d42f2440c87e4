"""Run a named query in Spark and its SQL twin in DuckDB, and compare the rows.

``python -m tests.compare [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


# The DuckDB type of each Spark type used in results.
DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    """``(name, type)`` pairs sorted by name, and the rows in that column order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_rows(df):
    columns = [(name, DUCK_TYPES.get(kind, kind)) for name, kind in df.dtypes]
    return rows_of(columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [(d[0], str(d[1])) for d in cursor.description]
    return rows_of(columns, cursor.fetchall())


def difference(spark_side, duck_side) -> str | None:
    if spark_side[0] != duck_side[0]:
        return f"columns {spark_side[0]} != {duck_side[0]}"
    if len(spark_side[1]) != len(duck_side[1]):
        return f"{len(spark_side[1])} rows != {len(duck_side[1])}"
    bad = [(a, b) for a, b in zip(spark_side[1], duck_side[1]) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main(folder="/root/testdata/sf0.01", *names):
    import __spark_entry__ as entry
    from keelson.session import build_session

    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g", spark__ui__enabled="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles = entry.oracle_sql()
    failed = 0
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            got = spark_rows(build(spark, folder))
            took = time.time() - begin
            if name in oracles:
                problem = difference(got, duck_rows(con, oracles[name]))
            else:
                problem = None if got[1] else "no rows"
        except Exception as error:  # noqa: BLE001
            took, problem = time.time() - begin, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {took:.2f}s rows={len(got[1]) if problem is None else '?'} "
              f"{'' if name in oracles else '(rows only)'} {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sys.exit(bool(main(*sys.argv[1:])))
