"""Access-log analysis over lines derived from the events, as a batch and as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions.logs import DEFAULT_PATTERNS, STRICT_PATTERNS, log_time, parse_access_log
from keelson.plans.registry import query
from keelson.session import work_dir
from keelson.sources import stream_lines, stream_table, table, write_lines
from keelson.streaming import best_per_window, run_available
from keelson.streaming import status_counts as count_status
from keelson.streaming import window_counts as count_windows

LINES_SQL = """
    lines AS (
        SELECT CASE WHEN event_id % 50 = 0
            THEN 'localhost - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0500] "-" - -'
            ELSE '10.0.' || user_id % 256 || '.' || event_id % 256 || ' - - ['
                 || strftime(ts, '%d/%b/%Y:%H:%M:%S') || CASE WHEN event_id % 2 = 0 THEN ' +0000' ELSE ' -0500' END
                 || '] "GET /' || event_type || ' HTTP/1.1" '
                 || CASE event_type WHEN 'error' THEN '500' WHEN 'signup' THEN '201' ELSE '200' END || ' '
                 || CASE WHEN event_type = 'view' THEN '-' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END
            END AS value
        FROM events)
"""
PARSE_SQL = """
    logs AS (
        SELECT regexp_extract(value, '{host}', 1) AS host, regexp_extract(value, '{time}', 1) AS timestamp,
               regexp_extract(value, '{request}', 1) AS method, regexp_extract(value, '{request}', 2) AS endpoint,
               regexp_extract(value, '{request}', 3) AS protocol,
               TRY_CAST(regexp_extract(value, '{status}', 1) AS INTEGER) AS status,
               TRY_CAST(regexp_extract(value, '{size}', 1) AS INTEGER) AS content_size
        FROM lines)
"""
LOGS_SQL = "WITH " + LINES_SQL + "," + PARSE_SQL.format(**DEFAULT_PATTERNS)
TIME_SQL = """
    timed AS (
        SELECT endpoint, CAST(try_strptime(substr(timestamp, 1, 20), '%d/%b/%Y:%H:%M:%S') AS TIMESTAMP)
               + CASE WHEN timestamp LIKE '%-0500' THEN INTERVAL 5 HOUR ELSE INTERVAL 0 HOUR END AS t
        FROM logs WHERE timestamp <> '')
"""
WINDOW_SQL = """
    SELECT time_bucket(INTERVAL '{slide}', {time}) - k * INTERVAL '{slide}' AS window_start,
           time_bucket(INTERVAL '{slide}', {time}) - k * INTERVAL '{slide}' + INTERVAL '{size}' AS window_end,
           {key}, count(*) AS n
    FROM {rows}, (SELECT unnest([0, 1, 2]) AS k) GROUP BY ALL
"""
EVENT_WINDOWS_SQL = WINDOW_SQL.format(
    slide="10 minutes", size="30 minutes", time="ts", key="event_type", rows="events"
)
URL_WINDOWS_SQL = (
    LOGS_SQL + "," + TIME_SQL
    + WINDOW_SQL.format(slide="10 seconds", size="30 seconds", time="t", key="endpoint", rows="timed")
)
BOUNDS = ("window_start", "window_end")
EVENT_WINDOWS = {"key": "event_type", "time_col": "ts", "size": "30 minutes", "slide": "10 minutes"}


def log_lines(events):
    """One access-log line per event; every fiftieth has no request, status or size."""
    clock = F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")
    kind = F.col("event_type")
    zone = F.when(F.col("event_id") % 2 == 0, " +0000").otherwise(" -0500")
    status = F.when(kind == "error", "500").when(kind == "signup", "201").otherwise("200")
    size = F.when(kind == "view", "-").otherwise(F.floor("value").cast("string"))
    good = F.concat(
        F.lit("10.0."), F.col("user_id") % 256, F.lit("."), F.col("event_id") % 256,
        F.lit(" - - ["), clock, zone, F.lit('] "GET /'), kind, F.lit(' HTTP/1.1" '), status, F.lit(" "), size,
    )
    bad = F.concat(F.lit("localhost - - ["), clock, F.lit(' -0500] "-" - -'))
    return events.select(F.when(F.col("event_id") % 50 == 0, bad).otherwise(good).alias("value"))


def _saved_lines(spark, folder):
    return write_lines(log_lines(table(spark, folder, "events")), work_dir(spark, "log"))


def _plain_times(windows):
    """Window bounds without a zone, as the tables store their times."""
    return windows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in BOUNDS})


def _utc_times(windows):
    """Window bounds as UTC clock times, whatever the zone of the session."""
    return windows.withColumns({c: F.convert_timezone(None, F.lit("UTC"), F.col(c)) for c in BOUNDS})


@query(LOGS_SQL + "SELECT * FROM logs")
def parse_logs(spark, folder):
    return parse_access_log(log_lines(table(spark, folder, "events")))


@query("WITH " + LINES_SQL + "," + PARSE_SQL.format(**STRICT_PATTERNS) + "SELECT * FROM logs")
def parse_logs_strict(spark, folder):
    return parse_access_log(log_lines(table(spark, folder, "events")), STRICT_PATTERNS)


STATUS_SQL = LOGS_SQL + "SELECT status, count(*) AS n FROM logs GROUP BY status"


@query(STATUS_SQL)
def status_counts(spark, folder):
    return count_status(parse_access_log(log_lines(table(spark, folder, "events"))))


@query(STATUS_SQL)
def stream_status_counts(spark, folder):
    lines = stream_lines(spark, _saved_lines(spark, folder))
    return run_available(count_status(parse_access_log(lines)), name="status_counts")


@query(STATUS_SQL)
def stream_status_triggers(spark, folder):
    """The same counts over several triggers: the state goes from one to the next."""
    path = work_dir(spark, "log-files")
    write_lines(log_lines(table(spark, folder, "events")).repartition(3, "value"), path)
    lines = stream_lines(spark, path, files_per_trigger=1)
    return run_available(count_status(parse_access_log(lines)), name="status_triggers")


@query(EVENT_WINDOWS_SQL)
def window_counts(spark, folder):
    return count_windows(table(spark, folder, "events"), **EVENT_WINDOWS)


def _timed_events(spark, folder):
    # Event time must carry a zone before it can have a watermark.
    return stream_table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query(EVENT_WINDOWS_SQL)
def stream_window_counts(spark, folder):
    counts = count_windows(_timed_events(spark, folder), **EVENT_WINDOWS).orderBy(F.desc("n"))
    return _plain_times(run_available(counts, name="window_counts"))


@query(f"""
    SELECT * FROM ({EVENT_WINDOWS_SQL}) WHERE window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
""")
def stream_window_watermark(spark, folder):
    """Append mode: only windows that the watermark has closed, each written once."""
    counts = count_windows(_timed_events(spark, folder), **EVENT_WINDOWS, watermark="1 hour")
    return _plain_times(run_available(counts, mode="append", name="window_watermark"))


def _url_windows(lines):
    logs = parse_access_log(lines).withColumn("event_time", log_time(F.col("timestamp")))
    return count_windows(logs.where(F.col("event_time").isNotNull()), time_col="event_time")


@query(URL_WINDOWS_SQL)
def url_windows(spark, folder):
    return _utc_times(_url_windows(log_lines(table(spark, folder, "events"))))


@query(URL_WINDOWS_SQL)
def stream_url_windows(spark, folder):
    counts = _url_windows(stream_lines(spark, _saved_lines(spark, folder))).orderBy(F.desc("n"))
    return _utc_times(run_available(counts, name="url_windows"))


def _stream_by_time(spark, folder, parts=3):
    """The log lines as files that arrive in order of the events' times, one for a trigger."""
    events = table(spark, folder, "events")
    first, last = events.agg(F.min(F.unix_seconds(F.col("ts").cast("timestamp"))), F.max(F.unix_seconds(F.col("ts").cast("timestamp")))).first()
    path = work_dir(spark, "log-files")
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    span = ((last or 0) - (first or 0)) // parts + 1
    for i in range(parts):
        part = events.where(second.between((first or 0) + i * span, (first or 0) + (i + 1) * span - 1))
        log_lines(part).coalesce(1).write.mode("append").text(path)
    return stream_lines(spark, path, files_per_trigger=1)


CLOSED = {"size": "30 minutes", "slide": "10 minutes"}


@query(LOGS_SQL + "," + TIME_SQL + ", windows AS (" + WINDOW_SQL.format(
    **CLOSED, time="t", key="endpoint", rows="timed"
) + """)
    SELECT * FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY n DESC, endpoint) AS INTEGER) AS rank
        FROM windows WHERE window_end <= (SELECT max(t) - INTERVAL 6 HOUR FROM timed))
    WHERE rank <= 3
""")
def stream_top_urls(spark, folder):
    """The three busiest endpoints of each closed window, reported once, while the stream goes on."""
    logs = parse_access_log(_stream_by_time(spark, folder)).withColumn("event_time", log_time(F.col("timestamp")))
    counts = count_windows(
        logs.where(F.col("event_time").isNotNull()), time_col="event_time", watermark="6 hours", **CLOSED
    )
    return _utc_times(run_available(counts, mode="append", name="top_urls", each=lambda b: best_per_window(b, k=3)))


@query(STATUS_SQL)
def stream_status_updates(spark, folder):
    """The counts again, from triggers that tell only what they changed."""
    counts = count_status(parse_access_log(_stream_by_time(spark, folder)))
    return run_available(counts, mode="update", name="status_updates", keys=["status"])


@query(LOGS_SQL + "SELECT endpoint, 3 * count(*) AS n FROM logs GROUP BY endpoint")
def stream_arrival_windows(spark, folder):
    """Windows over arrival time depend on the clock, but each line always lands in three of them."""
    counts = count_windows(parse_access_log(stream_lines(spark, _saved_lines(spark, folder))))
    windows = run_available(counts, name="arrival_windows")
    return windows.groupBy("endpoint").agg(F.sum("n").alias("n"))
