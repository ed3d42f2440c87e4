import pytest

from keelson.session import work_dir
from keelson.sources import parse_adjacency, read_delimited, read_inferred, read_lines, select_positional
from keelson.sources import write_lines


def save(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize("sep", [",", "\t", "|", " ", "::"])
def test_separators(spark, tmp_path, sep):
    path = save(tmp_path / "f", "\n".join(sep.join(r) for r in [("1", "a", "2.5"), ("2", "b", "x")]))
    rows = read_delimited(spark, path, "id int, name string, score double", sep=sep).collect()
    assert [tuple(r) for r in rows] == [(1, "a", 2.5), (2, "b", None)]


def test_narrow_schema_and_charset(spark, tmp_path):
    path = save(tmp_path / "items", "1|Café|x|y\n2|Naïve|z|w\n", "iso-8859-1")
    names = read_delimited(spark, path, "id int, title string", sep="|", encoding="ISO-8859-1")
    assert [tuple(r) for r in names.collect()] == [(1, "Café"), (2, "Naïve")]


def test_quoted_names(spark, tmp_path):
    path = save(tmp_path / "names", '1 "LONG NAME/WITH SLASH"\n2 "SHORT"\n')
    names = read_delimited(spark, path, "id int, name string", sep=" ")
    assert [r.name for r in names.collect()] == ["LONG NAME/WITH SLASH", "SHORT"]


def test_inferred_header_with_byte_order_mark(spark, tmp_path):
    path = save(tmp_path / "houses", "﻿No,Age,Price\n1,32,37.9\n2,19.5,42.2\n")
    df = read_inferred(spark, path)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("No", "int"), ("Age", "double"), ("Price", "double")]


def test_positional_fields(spark):
    df = lines(spark, "0,Ono,31,350", "1,Pia,x,2", "2,Rui")
    got = select_positional(df, [(2, "int", "age"), (3, "int", "friends")]).collect()
    assert [tuple(r) for r in got] == [(31, 350), (None, 2), (None, None)]


def test_positional_fields_on_whitespace(spark):
    got = select_positional(lines(spark, "191\t248  3\t881000001"), [(2, "int", "rating")], sep=None)
    assert got.first().rating == 3


def test_adjacency_lines(spark):
    df = parse_adjacency(lines(spark, "5301 14 1  1 7 ", "9", "", "x 1", " 5 \t6 q"))
    assert {r.id: r.connections for r in df.collect()} == {5301: [14, 1, 1, 7], 9: [], 5: [6, None]}


def test_lines_roundtrip(spark):
    path = write_lines(lines(spark, "a", "b c"), work_dir(spark, "lines"))
    assert sorted(r.value for r in read_lines(spark, path).collect()) == ["a", "b c"]


def test_work_dir_follows_the_session(spark):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_dir(spark, "x") != work_dir(spark, "x")


def test_a_stream_of_a_table_in_one_file_or_many(spark, tmp_path):
    from keelson.sources import stream_table, table
    from keelson.streaming import run_available

    rows = [(i, None, i % 3, "view", 1.0, "{}") for i in range(50)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    df = spark.createDataFrame(rows, schema)
    df.repartition(4).write.parquet(f"{tmp_path}/many/events.parquet")
    df.coalesce(1).write.parquet(f"{tmp_path}/part")
    (tmp_path / "one").mkdir()
    next((tmp_path / "part").glob("part-*.parquet")).rename(tmp_path / "one" / "events.parquet")
    for layout in ("one", "many"):
        found = run_available(stream_table(spark, f"{tmp_path}/{layout}", "events"), mode="append")
        assert found.count() == table(spark, f"{tmp_path}/{layout}", "events").count() == 50
