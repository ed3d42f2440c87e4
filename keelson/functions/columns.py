"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What ends a word. The first agrees with Unicode-aware regex engines that treat
# letters, numbers and "_" as word characters, the second with ASCII-only ones.
UNICODE_BREAK = r"[^\p{L}\p{N}_]+"
ASCII_BREAK = r"\W+"


def words(text: Column, unicode: bool = True) -> Column:
    """Lower-case words of a text, as an array. Text edges may give empty words."""
    return F.split(F.lower(text), UNICODE_BREAK if unicode else ASCII_BREAK)


def to_ascii(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")


def safe_ratio(numerator: Column, denominator: Column, zero: float | None = 0.0) -> Column:
    """``numerator / denominator``, or ``zero`` where the denominator is 0 (ANSI mode would raise)."""
    return F.when(denominator != 0, numerator / denominator).when(denominator == 0, F.lit(zero))


def affine(value: Column, scale: float, offset: float, places: int | None = None) -> Column:
    """Unit conversion ``value * scale + offset``, such as tenths of Celsius to Fahrenheit (.18, 32)."""
    out = value * F.lit(scale) + F.lit(offset)
    return out if places is None else F.round(out, places)


def single_blanks(line: Column) -> Column:
    """Every whitespace character of a line as a blank."""
    return F.translate(line, "\t\n\r\f\v", "     ")


def tokens_of(line: Column) -> Column:
    """Whitespace-separated tokens of a line, as an array without empty ones.

    A one-character split skips the regex engine, which would compile its pattern per line.
    """
    return F.array_remove(F.split(single_blanks(line), " "), "")


def field(line: Column, sep: str | None, index: int, kind: str) -> Column:
    """Field ``index`` of a separated line, NULL if absent or not of type ``kind``.

    ``sep=None`` splits on runs of whitespace.
    """
    parts = tokens_of(line) if sep is None else F.split(line, re.escape(sep))
    return F.get(parts, F.lit(index)).try_cast(kind)


def other_side(x: Column, y: Column, key: Column) -> Column:
    """The member of the pair ``(x, y)`` that is not ``key``."""
    return F.when(x != key, x).otherwise(y)


def sort_keys(order: Iterable[str]) -> list[Column]:
    """Sort expressions from names; a leading ``-`` means descending with NULLs last."""
    return [F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc_nulls_first(c) for c in order]


def row_struct(columns: Iterable[str]) -> Column:
    """Columns as one comparable value, ordered like a multi-column ascending sort."""
    return F.struct(*(F.col(c) for c in columns))
