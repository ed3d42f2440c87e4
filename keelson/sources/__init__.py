from keelson.sources.delimited import read_delimited, read_inferred, write_delimited
from keelson.sources.lines import (
    parse_adjacency,
    read_lines,
    select_positional,
    stream_lines,
    write_lines,
)
from keelson.sources.tables import stream_table, table

__all__ = [
    "parse_adjacency",
    "read_delimited",
    "read_inferred",
    "read_lines",
    "select_positional",
    "stream_lines",
    "stream_table",
    "table",
    "write_delimited",
    "write_lines",
]
