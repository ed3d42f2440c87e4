"""Access-log fields. The same projection serves a batch of lines and a stream of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Common log format. The strict set wants a dot in the host and a zone west of
# Greenwich; other lines get '' there. The default set takes any host and any zone.
STRICT_PATTERNS = {
    "host": r"(^\S+\.[\S+\.]+\S+)\s",
    "time": r"\[(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} -\d{4})]",
    "request": r"\"(\S+)\s(\S+)\s*(\S*)\"",
    "status": r"\s(\d{3})\s",
    "size": r"\s(\d+)$",
}
DEFAULT_PATTERNS = {
    **STRICT_PATTERNS,
    "host": r"^(\S+)\s",
    "time": r"\[(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4})]",
}
TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"


def parse_access_log(
    lines: DataFrame, patterns: dict[str, str] = DEFAULT_PATTERNS, value: str = "value"
) -> DataFrame:
    """``(host, timestamp, method, endpoint, protocol, status, content_size)`` of each line.

    Text that a pattern does not find is ``''``; status and size that are not numbers are NULL.
    """

    def part(name: str, group: int = 1) -> Column:
        return F.regexp_extract(F.col(value), patterns[name], group)

    return lines.select(
        part("host").alias("host"),
        part("time").alias("timestamp"),
        part("request", 1).alias("method"),
        part("request", 2).alias("endpoint"),
        part("request", 3).alias("protocol"),
        part("status").try_cast("int").alias("status"),
        part("size").try_cast("int").alias("content_size"),
    )


def log_time(timestamp: Column) -> Column:
    """The log's own time as a timestamp, NULL where it does not parse."""
    return F.try_to_timestamp(timestamp, F.lit(TIME_FORMAT))
