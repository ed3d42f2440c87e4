"""Text formats: written from a table, read back with types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.plans.registry import query
from keelson.session import work_dir
from keelson.sources import read_delimited, read_inferred, read_lines, select_positional, table
from keelson.sources import write_delimited, write_lines

PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double"
PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"]

# The layouts to read and write, as (tag, reader and writer options).
LAYOUTS = [
    ("comma", {"sep": ","}),
    ("header", {"sep": ",", "header": True}),
    ("tab", {"sep": "\t"}),
    ("pipe", {"sep": "|", "encoding": "ISO-8859-1"}),
    ("space", {"sep": " "}),
    ("colons", {"sep": "::"}),
]


@query("""
    SELECT layout, p_partkey, p_name || ' é' AS p_name, p_brand, p_size, p_retailprice
    FROM part, (SELECT unnest(['comma', 'header', 'tab', 'pipe', 'space', 'colons', 'inferred']) AS layout)
""")
def delimited_roundtrip(spark, folder):
    root = work_dir(spark, "delimited")
    accented = F.concat("p_name", F.lit(" é")).alias("p_name")
    parts = table(spark, folder, "part").select(
        *(accented if c == "p_name" else F.col(c) for c in PART_COLUMNS)
    )
    copies = []
    for tag, options in LAYOUTS:
        path = write_delimited(parts, f"{root}/{tag}", **options)
        copies.append(read_delimited(spark, path, PART_SCHEMA, **options).withColumn("layout", F.lit(tag)))
    inferred = read_inferred(spark, f"{root}/header").withColumn("p_partkey", F.col("p_partkey").cast("bigint"))
    copies.append(inferred.withColumn("layout", F.lit("inferred")))
    return reduce(DataFrame.unionByName, copies)


@query("SELECT p_partkey, p_name FROM part")
def narrow_schema_scan(spark, folder):
    """A schema narrower than the file: the columns to the right are not read."""
    root = work_dir(spark, "narrow")
    path = write_delimited(table(spark, folder, "part"), f"{root}/part", sep="|", encoding="ISO-8859-1")
    return read_delimited(spark, path, "p_partkey bigint, p_name string", sep="|", encoding="ISO-8859-1")


@query("""
    SELECT p_partkey AS part, p_brand AS brand,
           CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE p_size END AS size, p_retailprice AS price
    FROM part
""")
def positional_parse(spark, folder):
    """Typed fields by position from saved lines; a field that is not a number gives NULL."""
    size = F.when(F.col("p_type") == "ECONOMY", "n/a").otherwise(F.col("p_size").cast("string"))
    line = F.concat_ws(",", "p_partkey", "p_name", "p_brand", size, "p_retailprice")
    root = work_dir(spark, "positional")
    path = write_lines(table(spark, folder, "part").select(line.alias("value")), f"{root}/part")
    fields = [(0, "bigint", "part"), (2, "string", "brand"), (3, "int", "size"), (4, "double", "price")]
    return select_positional(read_lines(spark, path), fields)


@query("""
    SELECT rating, count(*) AS n FROM
      (SELECT CAST(l_quantity AS INTEGER) AS rating FROM lineitem) GROUP BY rating
""")
def histogram_of_lines(spark, folder):
    """Histogram of the third blank-separated field of each line."""
    line = F.concat_ws("\t", "l_orderkey", "l_partkey", F.col("l_quantity").cast("int"), "l_linenumber")
    lines = table(spark, folder, "lineitem").select(line.alias("value"))
    ratings = select_positional(lines, [(2, "int", "rating")], sep=None)
    return ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("n"))
