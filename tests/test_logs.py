import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from keelson.functions.logs import STRICT_PATTERNS, log_time, parse_access_log
from keelson.session import work_dir
from keelson.sources import stream_lines
from keelson.streaming import best_per_window, run_available, start_console, status_counts, window_counts

OK = '10.0.0.1 - - [29/Nov/2015:03:50:05 -0500] "GET /x HTTP/1.1" 200 51'
EAST = '10.0.0.1 - - [29/Nov/2015:03:50:05 +0000] "GET /x HTTP/1.1" 404 -'
BAD = 'localhost - - [29/Nov/2015:03:50:05 -0500] "-" 400 0'
JUNK = "not a log line"


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_fields(spark):
    got = [tuple(r) for r in parse_access_log(lines(spark, OK, EAST, BAD, JUNK)).collect()]
    assert got == [
        ("10.0.0.1", "29/Nov/2015:03:50:05 -0500", "GET", "/x", "HTTP/1.1", 200, 51),
        ("10.0.0.1", "29/Nov/2015:03:50:05 +0000", "GET", "/x", "HTTP/1.1", 404, None),
        ("localhost", "29/Nov/2015:03:50:05 -0500", "", "", "", 400, 0),
        ("not", "", "", "", "", None, None),
    ]


def test_strict_patterns(spark):
    got = parse_access_log(lines(spark, OK, EAST, BAD), STRICT_PATTERNS).select("host", "timestamp").collect()
    assert [tuple(r) for r in got] == [
        ("10.0.0.1", "29/Nov/2015:03:50:05 -0500"), ("10.0.0.1", ""), ("", "29/Nov/2015:03:50:05 -0500")]


def test_log_time(spark):
    got = parse_access_log(lines(spark, OK, JUNK)).select(log_time(F.col("timestamp")).cast("string").alias("t"))
    assert [r.t for r in got.collect()] == ["2015-11-29 08:50:05", None]


@pytest.fixture(scope="module")
def log_folder(spark):
    path = work_dir(spark, "logs")
    for i in range(4):  # four files, so four triggers below
        values = [OK.replace("03:50:05", f"03:5{i}:{s:02d}") for s in range(0, 60, 7)] + [BAD, EAST.replace("03:50", "08:50"), JUNK]
        lines(spark, *values).coalesce(1).write.mode("append").text(path)
    return path


def batch_and_stream(spark, folder):
    return parse_access_log(spark.read.text(folder)), parse_access_log(stream_lines(spark, folder, 1))


def test_stream_counts_equal_batch_counts(spark, log_folder):
    batch, stream = batch_and_stream(spark, log_folder)
    want = {(r.status, r.n) for r in status_counts(batch).collect()}
    got = {(r.status, r.n) for r in run_available(status_counts(stream)).collect()}
    assert got == want and (None, 4) in got


def timed(logs):
    return logs.withColumn("t", log_time(F.col("timestamp"))).where("t IS NOT NULL")


def test_stream_windows_equal_batch_windows(spark, log_folder):
    batch, stream = batch_and_stream(spark, log_folder)
    want = sorted(tuple(r) for r in window_counts(timed(batch), time_col="t").collect())
    counts = window_counts(timed(stream), time_col="t").orderBy(F.desc("n"))
    assert sorted(tuple(r) for r in run_available(counts).collect()) == want
    assert sum(w[3] for w in want) == 3 * timed(batch).count()


def test_append_mode_writes_each_closed_window_once(spark, log_folder):
    batch, stream = batch_and_stream(spark, log_folder)
    # Late by up to five minutes at most, so nothing is dropped; windows near the end stay open.
    counts = window_counts(timed(stream), time_col="t", watermark="10 minutes")
    closed = [tuple(r) for r in run_available(counts, mode="append").collect()]
    whole = [tuple(r) for r in window_counts(timed(batch), time_col="t").collect()]
    assert len(closed) == len(set(closed)) and set(closed) <= set(whole)
    latest = timed(batch).agg(F.max("t")).first()[0]
    assert {w[:3] for w in closed} == {w[:3] for w in whole if (latest - w[1]).total_seconds() >= 600}


def test_arrival_time_puts_a_row_in_three_windows(spark):
    counts = window_counts(parse_access_log(lines(spark, OK, OK)))
    assert counts.agg(F.sum("n")).first()[0] == 6


def test_console_sink(spark, log_folder, capfd):
    _, stream = batch_and_stream(spark, log_folder)
    query = start_console(status_counts(stream), name="console_counts", availableNow=True)
    assert query.awaitTermination(120) and query.exception() is None


def test_modes_without_a_table_are_refused(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\n")
    counts = spark.readStream.text(str(tmp_path / "in")).groupBy("value").count()
    with pytest.raises(ValueError, match="keys"):
        run_available(counts, mode="update")
    with pytest.raises(ValueError, match="other"):
        run_available(counts, mode="other")


def test_updates_give_the_complete_table(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i, text in enumerate(("a\nb\n", "a\n\n", "c\nb\n")):
        (source / f"{i}.txt").write_text(text)
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(source))
    counts = stream.select(F.nullif("value", F.lit("")).alias("value")).groupBy("value").count()
    complete = run_available(counts)
    found = run_available(counts, mode="update", keys=["value"])
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in complete.collect()}
    assert {tuple(r) for r in found.collect()} == {("a", 2), ("b", 2), ("c", 1), (None, 1)}


def test_a_replayed_trigger_changes_nothing(spark, tmp_path):
    """Also after the trigger has been written, and with the snapshot that came before it."""
    from keelson.streaming.runs import triggers, write_trigger

    path = str(tmp_path / "result")
    parts = [[("a", 1), ("b", 1), (None, 1)], [("a", 2), (None, 5)], [("c", 1), ("b", 7)]]
    frames = [spark.createDataFrame(p, "k string, n int") for p in parts]
    for trigger in (0, 1, 1, 2, 2):
        write_trigger(frames[trigger], trigger, path, "update", ["k"])
        kept = triggers(spark, path)
        assert kept == list(range(max(0, trigger - 1), trigger + 1))
    rows = spark.read.parquet(f"{path}/trigger=2").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted([("a", 2), ("b", 7), ("c", 1), (None, 5)], key=repr)


def test_closed_windows_report_their_best_once(spark, tmp_path):
    """Over three triggers: each window once, in the trigger that closes it, with all of its counts."""
    source = tmp_path / "in"
    source.mkdir()
    hits = [(60 * i + j, f"/{(i * j) % 4}") for i in range(30) for j in range(12)]
    for n in range(3):
        part = hits[n * 120 : (n + 1) * 120]
        (source / f"{n}.txt").write_text("".join(f"{t} {url}\n" for t, url in part))
        os.utime(source / f"{n}.txt", (1_000_000 + n, 1_000_000 + n))
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(source))
    cut = F.split("value", " ")
    hit = stream.select(F.timestamp_seconds(cut[0].cast("int")).alias("t"), cut[1].alias("endpoint"))
    counts = window_counts(hit, time_col="t", size="2 minutes", slide="1 minute", watermark="3 minutes")
    found = run_available(counts, mode="append", each=lambda b: best_per_window(b, k=2))
    assert len(found.select(F.input_file_name()).distinct().collect()) > 1
    got = {(r.window_end.timestamp(), r["rank"]): (r.endpoint, r.n) for r in found.collect()}
    assert len(got) == found.count()
    want = {}
    for end in range(60, 60 * 31 + 1, 60):
        inside = Counter(url for t, url in hits if end - 120 <= t < end)
        if inside and end <= hits[-1][0] - 180:
            for rank, (url, n) in enumerate(sorted(inside.items(), key=lambda x: (-x[1], x[0]))[:2], 1):
                want[end, rank] = (url, n)
    assert got == want


def test_only_the_last_trigger_is_kept(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i, text in enumerate(("a\nb\n", "a\n", "b\nb\n")):
        (source / f"{i}.txt").write_text(text)
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(source))
    found = run_available(stream.groupBy("value").count())
    assert {tuple(r) for r in found.collect()} == {("a", 2), ("b", 3)}
    (path,) = found.inputFiles()[:1]
    folder = path.split("/trigger=")[0].removeprefix("file://")
    assert [x for x in os.listdir(folder) if not x.startswith(".")] == ["trigger=2"]
